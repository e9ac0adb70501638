"""Relational and ordered-sequence operators."""
