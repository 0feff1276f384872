"""Relational and linear-algebra operators."""
