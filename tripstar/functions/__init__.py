"""Column expressions: exact arithmetic, keys and durations, cleaning, labels."""
