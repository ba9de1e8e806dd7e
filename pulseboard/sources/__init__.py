"""Readers for batch tables and streams."""
