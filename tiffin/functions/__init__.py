"""Column expressions: forgiving casts, exact arithmetic, masking."""
