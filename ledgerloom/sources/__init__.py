"""Readers of exports."""
