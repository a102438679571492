"""Incremental junction counts as a stream of files."""
