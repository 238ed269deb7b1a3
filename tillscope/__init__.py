"""Retail order-line analytics as plain DataFrame-to-DataFrame functions."""
