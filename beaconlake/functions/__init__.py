"""Column expressions and driver-side time helpers shared by the operators."""
