"""Citation tables and identifier translation as Spark jobs."""
