"""Telemetry analytics on Spark: ingest, daily rollups, incident lifecycles and KPI reads."""
