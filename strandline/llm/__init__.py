"""Operators on duplicate groups and text corpora. Nothing outside this subpackage imports it."""
