"""Scans that bring posts into the canonical columns, and sinks for every stage."""
