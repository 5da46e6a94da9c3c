"""End-to-end jobs over the tables and their DuckDB check SQL."""
