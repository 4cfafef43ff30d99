"""Declared table shapes: raw export, wide flat table, marts and logs."""
