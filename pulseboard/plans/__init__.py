"""Registered queries and whole jobs."""
