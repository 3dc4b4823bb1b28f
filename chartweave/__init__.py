"""chartweave: a Spark-first engine for record-level text, tables and evidence retrieval."""
