"""Streaming forms of the positional sessions and windows, on event time."""
