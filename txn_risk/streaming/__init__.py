"""Structured Streaming: replay, ingest to the lake, keyed 24-hour state and scoring."""
