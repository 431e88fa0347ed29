"""Structured Streaming jobs: event landing, streaming de-duplication, streaming upserts."""
