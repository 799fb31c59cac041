"""Registered queries (catalog) and their SQL statements (oracle)."""
