"""Health-triage analytics as Spark DataFrame jobs."""
