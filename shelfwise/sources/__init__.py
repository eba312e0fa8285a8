"""Readers: tenants, tables and the typed scans of each input."""
