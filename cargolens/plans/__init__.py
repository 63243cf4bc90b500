"""Composed reports and documents over a mapping of freight tables."""
