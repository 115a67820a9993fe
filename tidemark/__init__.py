"""Version adoption analytics as Spark DataFrame operators and batch jobs."""
