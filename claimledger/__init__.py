"""Medical-billing balances and the charge-level warehouse fact, as Spark DataFrame jobs."""
