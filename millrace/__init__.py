"""Incremental ETL operators and jobs as Spark DataFrame plans."""
