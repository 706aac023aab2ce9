"""Column expressions: value normalisation, classification and wording."""
