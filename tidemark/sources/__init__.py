"""Landed pages and stored tables."""
