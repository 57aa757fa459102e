"""DuckDB oracle SQL for the correctness check."""
