"""Reading, landing and refreshing panel tables."""
