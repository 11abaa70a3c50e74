"""Readers and writers at the edges: files, JDBC, message topics, report sinks."""
