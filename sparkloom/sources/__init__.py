"""Readers that turn files and bytes into rows."""
