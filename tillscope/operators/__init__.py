"""Operators on raw, uploaded and stored rows."""
