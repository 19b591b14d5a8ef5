"""Whole queries and jobs."""
