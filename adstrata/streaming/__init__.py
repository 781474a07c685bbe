"""Structured Streaming forms of the lake's steps."""
