"""Readers, writers, tables, exports and staged intermediate results."""
