"""Column-level helpers: decimal/null semantics and the extract formulas."""
