"""Column-level functions: vector arithmetic, nearest centre, text helpers."""
