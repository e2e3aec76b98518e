"""Sinks. Each can be run again with the same input without changing the result."""
