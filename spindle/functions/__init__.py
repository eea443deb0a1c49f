"""Column expressions: casts, names and labels, masking."""
