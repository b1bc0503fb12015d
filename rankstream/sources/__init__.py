"""Readers: landing JSON, streams, log records."""
