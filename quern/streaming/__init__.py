"""Structured Streaming over growing folders."""
