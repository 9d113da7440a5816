"""Incremental runs on file streams."""
