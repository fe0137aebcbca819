"""Column expressions: geography, delivery rules, time."""
