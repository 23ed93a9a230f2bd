"""Daily-snapshot star schema on Spark: staging, dimensions, daily fact, marts and data tests."""
