"""Labour-market analytics as composable Spark DataFrame jobs."""
