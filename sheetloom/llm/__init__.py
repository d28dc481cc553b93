"""Operators for cleaning large text corpora. Nothing else in the library imports this subpackage."""
