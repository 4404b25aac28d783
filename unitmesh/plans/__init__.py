"""Query plans: fixture views, named queries and their SQL oracles."""
