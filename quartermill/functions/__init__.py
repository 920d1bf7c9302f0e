"""Column expressions and distribution helpers shared by the operators."""
