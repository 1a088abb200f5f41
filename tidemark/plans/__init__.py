"""Queries and loads built from the operators."""
