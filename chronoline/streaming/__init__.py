"""Structured Streaming: the event-time cursor source and the idempotent point sink."""
