"""Column expressions and small table helpers shared by all operators."""
