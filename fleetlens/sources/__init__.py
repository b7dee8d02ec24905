"""Readers for what has landed in storage."""
