"""Registered queries over the given star-schema tables and their DuckDB counterparts."""
