"""Readers and the keyed table."""
