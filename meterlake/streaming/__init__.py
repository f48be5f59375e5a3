"""Structured Streaming jobs: event intake, live quality split, live marts."""
