"""Readers of topics, change records and look-up tables."""
