"""Scans: every function returns a lazy DataFrame."""
