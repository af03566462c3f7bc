"""Incremental (Structured Streaming) drivers."""
