"""Structured Streaming runners: the only place where queries are started."""
