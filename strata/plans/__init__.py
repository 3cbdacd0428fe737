"""Stand-in inputs, registered queries, oracle SQL and the end-to-end run."""
