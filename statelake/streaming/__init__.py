"""Structured Streaming drivers for the batch transforms."""
