"""Record shredding, reporting and incremental loading on Spark."""
