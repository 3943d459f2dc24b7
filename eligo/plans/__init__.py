"""Whole workflows as chains of DataFrame transforms."""
