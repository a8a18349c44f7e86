"""Readers: log files, object inventories, object contents."""
