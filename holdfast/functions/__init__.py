"""Column expressions: no job is run here."""
