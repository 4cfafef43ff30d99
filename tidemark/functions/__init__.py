"""Column expressions: key-value bag lookups and day arithmetic."""
