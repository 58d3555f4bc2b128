"""Whole jobs: from input paths to written results."""
