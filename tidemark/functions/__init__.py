"""Column-level building blocks and fixed values."""
