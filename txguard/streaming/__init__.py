"""Structured Streaming side."""
