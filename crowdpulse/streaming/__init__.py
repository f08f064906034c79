"""Streaming queries: sinks, fan-out, waiting, and the views of the users table."""
