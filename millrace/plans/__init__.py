"""Ready-made jobs and queries."""
