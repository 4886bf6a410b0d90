"""Column-level building blocks: every function takes and returns native columns."""
