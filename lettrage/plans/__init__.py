"""Reports and runs composed from the operators."""
