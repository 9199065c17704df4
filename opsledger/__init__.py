"""Log, returns, recommendation and graph analytics as plain Spark DataFrame jobs."""
