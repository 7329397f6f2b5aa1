"""Column expressions: text, time and marketing fields."""
