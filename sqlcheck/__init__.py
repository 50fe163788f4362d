"""DuckDB oracle SQL for the registered queries (test harness, not library)."""
