"""Readers and writers for the text formats, plus the shared scratch tables."""
