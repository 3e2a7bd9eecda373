"""The event pipeline as Structured Streaming queries."""
