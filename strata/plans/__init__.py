"""Registered query catalog (Spark builders) and the matching DuckDB oracle SQL."""
