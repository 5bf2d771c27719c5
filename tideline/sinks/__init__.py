"""Sinks of events."""
