"""Structured Streaming form of the alert feed."""
