"""Structured Streaming: keyed state and the running jobs."""
