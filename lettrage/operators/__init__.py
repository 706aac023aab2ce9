"""DataFrame operators: parsing, schema fitting, period, coverage, matching."""
