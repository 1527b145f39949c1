"""Column expressions: numeric, time and sun-position helpers."""
