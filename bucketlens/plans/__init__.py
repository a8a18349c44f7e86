"""Registered queries, their DuckDB oracle SQL, derived inputs, plan checks."""
