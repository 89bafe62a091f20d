"""Time-ordered event and media analytics as Spark DataFrame jobs."""
