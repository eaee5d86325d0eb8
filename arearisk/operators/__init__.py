"""Table-level operators."""
