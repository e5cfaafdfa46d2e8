"""Stored tables read with their declared schema, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconlake.schemas import TABLES

# Text formats carry no schema of their own, so a declared one is always given.
FORMATS = ("parquet", "orc", "json", "csv")


def _check(name: str, fmt: str) -> None:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known: {', '.join(sorted(TABLES))}")
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; supported: {', '.join(FORMATS)}")


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet", **options) -> DataFrame:
    _check(name, fmt)
    return spark.read.schema(TABLES[name]).options(**options).format(fmt).load(path)


def read_raw(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Raw telemetry stored under ``event_date=/batch_id=`` folders; the date prunes day-sized scans."""
    _check(name, "parquet")
    return spark.read.schema(f"{TABLES[name]}, event_date date, batch_id string").parquet(path).drop("batch_id")


def stream_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet", **options) -> DataFrame:
    _check(name, fmt)
    return spark.readStream.schema(TABLES[name]).options(**options).format(fmt).load(path)
