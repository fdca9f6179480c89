"""Checked query registry and end-to-end plans."""
