"""Readers and writers: canonical events, raw log lines and artifacts."""
