"""Bounded streams over landed files."""
