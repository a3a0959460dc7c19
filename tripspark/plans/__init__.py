"""Composed work: the registered queries (catalog), their DuckDB oracle,
end-to-end jobs and plan inspection helpers."""
