"""Writes: keyed merges as frames, slice replacement, versions, files."""
