"""Column expressions: text clean-up, repair, validity checks, dates and numbers."""
