"""Column-level functions shared by the operators."""
