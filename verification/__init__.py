"""Checks against the given test tables: source tables, queries over them, and the same queries in plain SQL."""
