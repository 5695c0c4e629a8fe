"""Column functions: event predicates, text parsing and scoring formulas."""
