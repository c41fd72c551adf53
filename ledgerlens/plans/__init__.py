"""Query registry (key → callable(spark, sf_dir)) and the DuckDB oracle SQL per key."""
