"""Plans: the pipeline jobs."""
