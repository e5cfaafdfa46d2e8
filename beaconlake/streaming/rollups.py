"""Continuously maintained rollups.

Each micro-batch is aggregated to additive parts (counts and sums per day), which are filed beside those already published
for the same dates: a batch writes what it adds, and dates with many parts are summed up now and then. Nothing waits for a
watermark, so a row counts on its own day however late it arrives; the published manifest remembers the last batch, so a
replay after a failure adds nothing twice. Parts are summed, and percentiles, means and top keywords derived, when read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconlake.operators import rollups
from beaconlake.plans.publish import Store
from beaconlake.streaming import deltas

# Additive part tables: name -> (aggregation of dated raw rows, keys, summed columns).
Part = tuple[Callable[[DataFrame], DataFrame], list[str], list[str]]

METRIC_PARTS: dict[str, Part] = {
    "part_latency": (
        rollups.latency_histogram, ["snapshot_date", "os_platform", "latency_ms"], ["requests", "errors"]
    ),
    "part_endpoints": (
        rollups.endpoint_sums, ["snapshot_date", "endpoint", "method"], ["latency_sum", "call_count"]
    ),
}
EVENT_PARTS: dict[str, Part] = {
    "part_funnel": (
        rollups.funnel_steps, ["snapshot_date", "os_platform", "searched", "keyword"], [*rollups.FUNNEL_COUNTS, "count"]
    ),
    "part_errors": (
        rollups.error_counts, ["snapshot_date", "os_platform", "error_name"], ["occurrence_count"]
    ),
    "part_screens": (
        rollups.screen_counts, ["snapshot_date", "os_platform", "screen_name"], ["visit_count"]
    ),
}


PARTS = METRIC_PARTS | EVENT_PARTS


def summed(table: str, rows: DataFrame) -> DataFrame:
    """One row for each key of a part table."""
    _, keys, sums = PARTS[table]
    return rows.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in sums))


def read_part(store: Store, table: str) -> DataFrame:
    return summed(table, deltas.read(store, table))


def maintain(
    raw: DataFrame, parts: dict[str, Part], store: Store, name: str, checkpoint: str, trigger: dict | None = None,
    most: int = deltas.MOST,
) -> StreamingQuery:
    """Keep the part tables of one raw stream up to date; all of them are published together per batch.

    A date with more than ``most`` parts is summed up by the next batch that adds to the table.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        run = store.begin(name, batch_id)
        if run.done:
            return
        dated = rollups.with_day(batch).persist()
        date = F.coalesce(F.col("snapshot_date").cast("string"), F.lit(deltas.NEVER))
        for table, (aggregate, _, _) in parts.items():
            deltas.add(run, table, aggregate(dated), date, partial(summed, table), most)
        run.publish()
        dated.unpersist()

    return (
        raw.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def api_performance(store: Store) -> DataFrame:
    return rollups.performance_from_histogram(read_part(store, "part_latency"))


def endpoint_latency(store: Store) -> DataFrame:
    return rollups.latency_from_sums(read_part(store, "part_endpoints"))


def funnel(store: Store) -> DataFrame:
    return rollups.funnel_from_steps(read_part(store, "part_funnel"))


def errors(store: Store) -> DataFrame:
    return read_part(store, "part_errors")


def screens(store: Store) -> DataFrame:
    return read_part(store, "part_screens")
