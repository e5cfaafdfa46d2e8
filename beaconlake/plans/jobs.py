"""Scheduled jobs: the nightly rollup with retention, the half-hourly history append, the ten-minute probe round."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.functions.clock import DAY, event_date, midnight, utc, utc_day, yesterday
from beaconlake.operators import rollups
from beaconlake.operators.incidents import active_incident_alert, apply_quota_poll, quota_poll_outbox
from beaconlake.operators.sinks import upsert_full
from beaconlake.plans.publish import Run, Store, delete_folder, folder_names
from beaconlake.schemas import SUMMARY_KEYS, TABLES
from beaconlake.sources.payloads import counts_snapshot, extract_usage, pivot_gauges, webhook_audit
from beaconlake.streaming.incidents import fold_probes, stage_notices
from beaconlake.streaming.ingest import compact, read_routed

log = logging.getLogger(__name__)

Rollup = Callable[[DataFrame, datetime | None, datetime | None], DataFrame]

# (summary table, raw input, rollup), in schedule order.
NIGHTLY: list[tuple[str, str, Rollup]] = [
    ("summary_api_performance", "metrics", rollups.daily_api_performance),
    ("summary_business_funnel", "events", rollups.daily_funnel),
    ("summary_crash_errors", "events", rollups.daily_errors),
    ("summary_screen_visits", "events", rollups.daily_screens),
    ("summary_api_endpoints", "metrics", rollups.daily_endpoint_latency),
]


def nightly(
    store: Store, raw: dict[str, DataFrame], since: datetime, until: datetime, jobs: list | None = None
) -> list[str]:
    """Roll up [since, until), merge into the summaries and publish all of them together.

    A rollup that fails is logged and left out; the others are still published. Returns the names that failed, so
    that the caller runs retention only when there are none. Bounds are UTC midnights: a part of a day would replace
    that day's summary rows.
    """
    if midnight(since) != utc(since) or midnight(until) != utc(until):
        raise ValueError(f"not whole UTC days: {since} to {until}")
    run, failed = store.begin(), []
    days = [f"snapshot_date={midnight(since) + n * DAY:%Y-%m-%d}" for n in range((until - since).days)]
    for name, source, build in NIGHTLY if jobs is None else jobs:
        try:
            fresh = build(raw[source], since, until)
            # Only the dates of this run are read and rewritten; the rest of the history stays where it is.
            stored = store.read(name, days)
            merged = fresh if stored is None else upsert_full(stored, fresh, SUMMARY_KEYS[name])
            run.stage(name, merged, "snapshot_date")
        except Exception:
            log.exception("rollup %s failed", name)
            failed.append(name)
    run.publish()
    return failed


def nightly_for(store: Store, raw: dict[str, DataFrame], as_of: datetime) -> list[str]:
    """The scheduled form: roll up the last complete UTC day."""
    return nightly(store, raw, *yesterday(as_of))


RAW_TABLES = {"events": "mobile_telemetry_events", "metrics": "mobile_telemetry_api_metrics"}


def daily(spark: SparkSession, store: Store, raw_root: str, as_of: datetime, keep_days: int = 3) -> list[str]:
    """Compaction of what the router has finished, nightly rollup of the stored raw tables, then raw retention if every
    rollup was published. Rows that are not compacted yet are rolled up too."""
    compact(spark, raw_root)
    raw = {source: read_routed(spark, raw_root, name) for source, name in RAW_TABLES.items()}
    failed = nightly_for(store, raw, as_of)
    if not failed:
        for name in RAW_TABLES.values():
            expire_dates(spark, f"{raw_root}/{name}", as_of, keep_days)
    return failed


def half_hourly(
    spark: SparkSession,
    store: Store,
    counts: DataFrame,
    gauges: DataFrame,
    usage: DataFrame,
    as_of: datetime,
    keep_days: int = 30,
) -> None:
    """Add one poll of counts and gauges, expire old history, and apply the usage poll to the incidents, all in one run.

    ``usage`` holds one response per resource (resource, body); its row count is the number of resources. A poll that is
    run again replaces its own rows.
    """
    run = store.begin()
    for name, rows in (("stats_history", counts_snapshot(counts)), ("app_metrics2", pivot_gauges(gauges))):
        stage_history(run, name, rows)
        first_kept = (midnight(as_of) - keep_days * DAY).date()
        run.drop(name, [part for part in run.parts(name) if (day := dated(part)) and day < first_kept])
    polls = extract_usage(usage).select("resource", F.col("rows_read").alias("rows_read_24h"))
    stored = store.read("quota_incidents")
    if stored is None:
        stored = spark.createDataFrame([], TABLES["incidents"])
    stage_notices(run, quota_poll_outbox(stored, polls, as_of), "quota_notices")
    run.stage("quota_incidents", apply_quota_poll(stored, polls, as_of))
    run.publish()


def ten_minutely(store: Store, probes: DataFrame, as_of: datetime, watched: str) -> None:
    """Fold one round of health probes, and repeat the alert of the watched component while its incident is active."""
    run = store.begin()
    fold_probes(run, probes)
    open_before = store.read("probe_incidents_open")
    if open_before is not None:
        stage_notices(run, active_incident_alert(open_before, watched, as_of), "alerts")
    run.publish()


def append_webhooks(deliveries: DataFrame, root: str, batch_id: str) -> None:
    """File one batch of webhook deliveries: audit rows by date, and what cannot be read with the reason.

    A batch that is run again replaces its own rows.
    """
    found = webhook_audit(deliveries)
    # A batch may hold a long history: as many files as its rows make, not one for each date and task.
    audit = found.accepted.withColumn("event_date", utc_day(F.col("created_at")))
    for name, rows, parts in (("github_app_metrics", audit, ["event_date"]), ("quarantined_webhooks", found.quarantine, [])):
        (
            rows.withColumn("batch_id", F.lit(batch_id))
            .hint("rebalance", *parts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts, "batch_id")
            .parquet(f"{root}/{name}")
        )


def filed_webhooks(spark: SparkSession, root: str) -> DataFrame:
    """Filed deliveries with the facts of their payloads, dated by ``event_date``."""
    return spark.read.parquet(f"{root}/github_app_metrics").drop("batch_id")


def append_raw(df: DataFrame, path: str) -> None:
    """Append rows (epoch-ms ``timestamp``) below ``event_date=/batch_id=`` folders, the layout of the router too."""
    filed = df.withColumn("event_date", event_date(F.col("timestamp"))).withColumn("batch_id", F.lit(uuid.uuid4().hex))
    filed.write.mode("append").partitionBy("event_date", "batch_id").parquet(path)


def stage_history(run: Run, name: str, polls: DataFrame) -> None:
    """Stage poll rows (timestamp ``timestamp``) with the other rows of their dates; rows of the same polls give way."""
    fresh = polls.withColumn("event_date", utc_day(F.col("timestamp"))).persist()
    # One poll has one time, so this is one date as a rule.
    days = [f"event_date={row[0]}" for row in fresh.select(F.col("event_date").cast("string")).distinct().collect()]
    stored = run.store.read(name, days)
    if stored is not None:
        fresh = stored.join(fresh.select("timestamp").distinct(), "timestamp", "left_anti").unionByName(fresh)
    run.stage(name, fresh, "event_date")


def dated(folder: str) -> date | None:
    """The date of an ``event_date=`` folder; None for any other name, such as that of rows without a time."""
    try:
        return date.fromisoformat(folder.removeprefix("event_date=")) if folder.startswith("event_date=") else None
    except ValueError:
        return None


def expire_dates(spark: SparkSession, path: str, as_of: datetime, days: int) -> list[str]:
    """Delete the ``event_date=`` folders that lie wholly before the retention cutoff, without reading a row.

    Rows of the cutoff day itself are left to the retention operators, which filter to the second.
    """
    first_kept = (midnight(as_of) - days * DAY).date()
    expired = sorted(name for name in folder_names(spark, path) if (day := dated(name)) and day < first_kept)
    for name in expired:
        delete_folder(spark, f"{path}/{name}")
    return expired
