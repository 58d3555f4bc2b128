"""Queries registered in __spark_entry__.py, each next to its SQL."""
