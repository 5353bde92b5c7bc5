"""Readers for change logs, relational snapshots, streams and generated logs."""
