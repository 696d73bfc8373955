"""Signal ingestion, name resolution and linking as Spark DataFrame operators."""
