"""Structured Streaming: windowed features, de-duplication, joins, and sinks that survive retries."""
