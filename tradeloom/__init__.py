"""Trade-finance and retail analytics expressed as Spark DataFrame jobs."""
