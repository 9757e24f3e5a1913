"""Streams."""
