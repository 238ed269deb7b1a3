"""Readers and generated data."""
