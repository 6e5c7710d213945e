"""Readers of databases and lake zones."""
