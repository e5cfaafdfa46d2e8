"""Upserts, updates and retention as table-in, table-out operators.

Keys compare null-safely, so a rerun replaces rows whose key holds a NULL instead of adding them again. Where a key is never
NULL, say so (``nullable=False``): the stored side of a table bucketed by the key (``store_bucketed``) is then joined where it
lies, and only the incoming rows are shuffled.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions.clock import DAY, utc


def _same_key(keys: list[str], nullable: bool) -> list[Column]:
    """Key equality between two sides aliased ``old`` and ``new``."""
    sides = [(F.col(f"old.{key}"), F.col(f"new.{key}")) for key in keys]
    return [old.eqNullSafe(new) if nullable else old == new for old, new in sides]


def store_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Write a table whose rows lie by the hash of their key, sorted by it in each bucket, one file a bucket."""
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(table)


def upsert_bucketed(
    table: str, into: str, incoming: DataFrame, keys: list[str], updated: list[str] | None = None, buckets: int = 200
) -> None:
    """``upsert_partial`` (or, without ``updated``, ``upsert_full``) of a bucketed table into a new one, bucketed alike.

    Stored rows are neither shuffled nor sorted: they are read by bucket, joined, and written to the same bucket.
    """
    stored = incoming.sparkSession.table(table)
    changed = [name for name in stored.columns if name not in keys] if updated is None else updated
    merged = upsert_partial(stored, incoming, keys, changed, nullable=False)
    merged.write.bucketBy(buckets, *keys).sortBy(*keys).mode("errorifexists").saveAsTable(into)


def upsert_partial(
    existing: DataFrame, incoming: DataFrame, keys: list[str], updated: list[str], nullable: bool = True
) -> DataFrame:
    """Insert new keys; for keys that exist change the ``updated`` columns only.

    One full outer join on unique keys: each side is computed and shuffled once.
    """
    old = existing.withColumn("_stored", F.lit(True)).alias("old")
    new = incoming.withColumn("_given", F.lit(True)).alias("new")

    def choose(column: str) -> Column:
        stored, given = F.col(f"old.{column}"), F.col(f"new.{column}")
        if column in updated:
            return F.when(F.col("_given"), given).otherwise(stored).alias(column)
        return F.when(F.col("_stored"), stored).otherwise(given).alias(column)

    return old.join(new, _same_key(keys, nullable), "full_outer").select(*map(choose, existing.columns))


def upsert_full(existing: DataFrame, incoming: DataFrame, keys: list[str], nullable: bool = True) -> DataFrame:
    """Incoming rows replace existing rows of the same key; other existing rows stay."""
    return upsert_partial(existing, incoming, keys, [name for name in existing.columns if name not in keys], nullable)


def insert_or_replace(existing: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """Whole-row replace by primary key."""
    return upsert_full(existing, incoming, [key])


def conditional_update(df: DataFrame, matches: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns on the rows that match; a NULL condition does not match. Row and column order stay."""
    set_to = {name: F.when(matches, value).otherwise(F.col(name)).alias(name) for name, value in changes.items()}
    return df.select(*(set_to.get(name, F.col(name)) for name in df.columns))


def resolve_component(incidents: DataFrame, component: str, at: datetime) -> DataFrame:
    """Close every active incident of a component."""
    active = (F.col("component") == component) & (F.col("status") == "active")
    return conditional_update(
        incidents, active, {"status": F.lit("resolved"), "resolved_at": F.lit(utc(at)).cast("timestamp")}
    )


def insert_incident(
    incidents: DataFrame, source: str, component: str, level: str, title: str, message: str, at: datetime
) -> DataFrame:
    """Append one active incident under a random version-4 UUID."""
    row = incidents.sparkSession.range(1).select(
        F.uuid().alias("id"),
        F.lit(source).alias("source"),
        F.lit(component).alias("component"),
        F.lit(level).alias("level"),
        F.lit(title).alias("title"),
        F.lit(message).alias("message"),
        F.lit("active").alias("status"),
        F.lit(utc(at)).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
    )
    return incidents.unionByName(row)


def retain_raw(raw: DataFrame, as_of: datetime, days: int = 3) -> DataFrame:
    """Raw rows of the last days, to the second; rows without a timestamp are never expired."""
    cutoff = int((utc(as_of) - days * DAY).timestamp()) * 1000
    return raw.where((F.col("timestamp") >= cutoff) | F.col("timestamp").isNull())


def retain_history(history: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    cutoff = utc(as_of) - days * DAY
    return history.where((F.col("timestamp") >= F.lit(cutoff)) | F.col("timestamp").isNull())
