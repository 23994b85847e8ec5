"""Operators for large-scale text corpora. Nothing else in the library imports this subpackage."""
