"""Structured Streaming: the latest reading per key."""
