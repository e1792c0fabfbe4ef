"""Behavioural features over entity and event logs, as DataFrame and Structured Streaming plans."""
