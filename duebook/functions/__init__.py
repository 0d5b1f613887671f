"""Column-valued helpers shared by the operators."""
