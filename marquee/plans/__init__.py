"""Registry of questions, the DuckDB oracle, plan inspection and the batch job."""
