"""Structured Streaming: message landing, dead letters and replay."""
