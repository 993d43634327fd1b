"""Structured Streaming operators; stateless ones reuse the batch expressions."""
