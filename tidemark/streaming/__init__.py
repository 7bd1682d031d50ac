"""Stateful operators on streams and the runner that starts queries."""
