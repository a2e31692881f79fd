"""Query catalog, oracle SQL and the end-to-end pipeline jobs."""
