"""Queries over the given tables that exercise the library, and their SQL."""
