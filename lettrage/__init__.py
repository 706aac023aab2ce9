"""Three-source invoice reconciliation as lazy Spark DataFrames."""
