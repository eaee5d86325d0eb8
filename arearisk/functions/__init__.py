"""Column-level building blocks: missing-value rules and scalar expressions."""
