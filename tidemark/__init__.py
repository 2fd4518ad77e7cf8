"""tidemark: a Spark-first engine for time-series ingest and query."""
