"""Column expressions: text, time, calendar, window statistics, error terms."""
