"""Record migration and reconciliation on Spark DataFrames."""
