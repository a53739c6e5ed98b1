"""Structured Streaming: ingest, windows, alerts, sinks and the trending table."""
