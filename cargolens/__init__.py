"""Freight and EDI analytics as Spark DataFrame jobs."""
