"""Model fits and scoring as Spark jobs."""
