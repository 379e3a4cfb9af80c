"""Whole flows: vendor payloads to canonical tables, and the import of an export."""
