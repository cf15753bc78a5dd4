"""Keep a large entity catalog current with Spark DataFrame jobs."""
