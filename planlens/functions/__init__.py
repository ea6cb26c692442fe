"""Column-level building blocks: casts and business rules."""
