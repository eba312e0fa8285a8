"""Queries over the supplied test tables, each with its SQL twin."""
