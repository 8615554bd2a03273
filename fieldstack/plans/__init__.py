"""Plans: request planning, the batch job, the named query catalog."""
