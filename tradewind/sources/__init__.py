"""Readers of landed files, tables, and small reference data."""
