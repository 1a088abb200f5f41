"""Structured Streaming consumers and the producer that feeds them."""
