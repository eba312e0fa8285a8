"""Whole jobs, and queries over their run records."""
