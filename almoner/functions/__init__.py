"""Column expressions: search predicates, scalar cleaning rules and text similarity."""
