"""Readers for files, messages and tables, in batch and as streams."""
