"""Structured Streaming: message decoding, ingest, de-duplication, hourly metrics."""
