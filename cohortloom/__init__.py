"""Clinical-imaging cohort analytics as Spark DataFrame jobs."""
