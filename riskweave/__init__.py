"""Transaction risk analytics as Spark jobs."""
