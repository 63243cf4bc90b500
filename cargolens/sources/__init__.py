"""Inbound tables, outbound queue and processing log."""
