"""Structured Streaming: message decoding and request scoring."""
