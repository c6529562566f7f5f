"""Column expressions over script text."""
