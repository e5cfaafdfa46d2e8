"""Scheduled jobs and the registry of named queries with their DuckDB counterparts."""
