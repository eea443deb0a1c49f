"""Declared schemas, their registry, matching and extension, and whole runs."""
