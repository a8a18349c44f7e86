"""Structured Streaming adapters for the same parsers and aggregates."""
