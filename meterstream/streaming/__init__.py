"""Structured Streaming: sources, replay staging, the aggregate and scoring queries, progress."""
