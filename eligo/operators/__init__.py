"""Relational operators: catalogue, comparison, review table, nesting."""
