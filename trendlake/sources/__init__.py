"""Scans: bronze files, tables and file listings."""
