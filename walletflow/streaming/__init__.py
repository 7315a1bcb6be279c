"""Structured Streaming forms of the landing -> table step."""
