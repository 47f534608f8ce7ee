"""Column expressions: money, calendar and text."""
