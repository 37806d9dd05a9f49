"""Readers for raw files, tables and marts."""
