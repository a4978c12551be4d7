"""Whole runs composed of the stages."""
