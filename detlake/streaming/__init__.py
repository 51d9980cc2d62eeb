"""Structured Streaming over the append-only event log."""
