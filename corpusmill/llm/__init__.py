"""Operators for preparing text corpora, and their registered queries (``queries`` modules, one per operator)."""
