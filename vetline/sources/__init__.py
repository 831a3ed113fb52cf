"""Readers: the given tables, derived fixture tables, allow-lists, messages."""
