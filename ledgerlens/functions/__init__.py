"""Column expressions: text folding, parsing, movement predicates and derived columns."""
