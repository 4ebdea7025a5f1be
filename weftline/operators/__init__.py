"""Relational and sequence operators."""
