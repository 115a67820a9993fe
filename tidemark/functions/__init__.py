"""Column expressions over versions, build ids and dates."""
