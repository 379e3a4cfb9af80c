"""Exports that keep arriving."""
