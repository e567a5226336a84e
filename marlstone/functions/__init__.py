"""Column functions: keys, evidence, casts, dates and amounts."""
