"""Column expressions of statement parsing."""
