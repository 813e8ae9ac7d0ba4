"""Sinks: ordered corpus text, one-row JSON documents, model tables."""
