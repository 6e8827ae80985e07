"""Operators over streams of diary events."""
