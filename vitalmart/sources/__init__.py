"""Readers, writers, fixed layouts and table naming."""
