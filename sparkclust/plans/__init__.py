"""Composite flows, registered queries and their DuckDB oracles."""
