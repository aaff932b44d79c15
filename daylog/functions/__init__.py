"""Column functions: casts and rounding, dates and durations, text, effort and classification."""
