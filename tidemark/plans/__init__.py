"""Model graph, query catalogue, oracle SQL and verification."""
