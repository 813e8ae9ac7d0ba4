"""Scans: driver tables, derived fixture views, XML dumps, benchmark sets."""
