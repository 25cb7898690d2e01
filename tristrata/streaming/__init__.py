"""Structured Streaming: starting queries, per-topic fan-out, quarantine, merge."""
