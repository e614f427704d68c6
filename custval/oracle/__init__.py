"""DuckDB oracle SQL, one statement per registered query key.

Each statement starts from the raw test tables (pre-registered views) and
rebuilds the canonical inputs with the fixture CTEs, so the check is an
independent re-computation of every job, not a replay of the Spark plan.
"""
