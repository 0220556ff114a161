"""Structured Streaming landing and stream-side cleaning."""
