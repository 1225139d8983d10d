"""Query plans built from the given tables, and their SQL twins."""
