"""Correctness checks: the DuckDB oracle SQL and a Spark-vs-oracle comparer."""
