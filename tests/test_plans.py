"""Shapes of plans that matter at scale."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconlake.operators import ci, incidents, ordered, reads, rollups, snapshots
from beaconlake.plans.registry import COMPONENTS, EVENTS_AS_OF, LANGUAGES, ORDERS_AS_OF, QUERIES, REPOSITORIES
from beaconlake.sources.derived import table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return [line for line in text.splitlines() if "Exchange" in line]


def test_top_keywords_are_cut_before_the_shuffle(spark, data):
    text = plan(rollups.daily_top_keywords(table(spark, data, "mobile_telemetry_events")))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_funnel_scans_once(spark, data):
    assert plan(rollups.daily_funnel(table(spark, data, "mobile_telemetry_events"))).count("FileScan") == 1


@pytest.mark.parametrize(("name", "scans"), [("funnel_totals", 1), ("mobile_snapshot_7d", 2)])
def test_several_grains_come_from_one_scan(spark, data, name, scans):
    text = plan(QUERIES[name](spark, data))
    assert text.count("FileScan") == scans
    assert len([line for line in exchanges(text) if "BroadcastExchange" not in line]) <= 5


def test_four_ci_datasets_scan_once(spark, data):
    df = ci.github_metrics(table(spark, data, "github_app_metrics"), ORDERS_AS_OF, LANGUAGES, "all_time")
    assert plan(df).count("FileScan") == 1 and plan(df).count("from_json") == 1


def test_rollups_aggregate_before_they_shuffle(spark, data):
    metrics = table(spark, data, "mobile_telemetry_api_metrics")
    for df in (rollups.daily_api_performance(metrics), rollups.daily_endpoint_latency(metrics)):
        text = plan(df)
        assert text.index("partial_") > 0 and "SortAggregate" not in text and "collect_list" not in text


def test_scans_read_only_needed_columns(spark, data):
    text = plan(rollups.daily_api_performance(table(spark, data, "mobile_telemetry_api_metrics")))
    read = text.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == {"ts", "user_id", "event_type", "value"}


def test_latest_lookups_do_not_sort_a_component(spark, data):
    latest = plan(snapshots.latest_incident_per_component(table(spark, data, "incidents"), COMPONENTS))
    repos = plan(ci.latest_per_repo(table(spark, data, "github_app_metrics"), REPOSITORIES))
    for text in (latest, repos):
        assert "Window" not in text and "BroadcastHashJoin" in text


FOLDS = {
    "probe_incidents": ("health_probes", incidents.probe_incidents),
    "ci_transitions": ("ci_runs", incidents.ci_transitions),
    "ci_incidents": ("ci_runs", lambda runs: incidents.ci_incidents(incidents.ci_transitions(runs))),
    "quota_outbox": ("usage_samples", lambda rows: incidents.quota_outbox(_stored_levels(rows))),
    "quota_incidents": ("usage_samples", lambda rows: incidents.quota_incidents(_stored_levels(rows))),
}


def _stored_levels(rows):
    return rows.withColumn("rows_read_24h", F.col("rows_read")).withColumn("level", incidents.quota_level(F.col("rows_read")))


@pytest.mark.parametrize("name", FOLDS)
def test_folds_read_and_shuffle_rows_once(spark, data, name, monkeypatch):
    first, keep = [], ordered.checkpointed
    monkeypatch.setattr(ordered, "checkpointed", lambda df: first.append(plan(df)) or keep(df))
    source, fold = FOLDS[name]
    rest = plan(fold(table(spark, data, source)))
    assert len(first) == 1 and first[0].count("FileScan") == 1 and "SortAggregate" not in first[0] + rest
    # the rows: one exchange, by key and slice; a window over a whole key sees one summary row for each slice
    assert len(exchanges(first[0])) == 1 and "hashpartitioning(_key" in first[0] and "_slice" in exchanges(first[0])[0]
    assert "FileScan" not in rest
    lines = rest.splitlines()
    for n, line in enumerate(lines):
        if "Exchange hashpartitioning(_key" in line and "_slice" not in line:
            assert any("(_row" in below and "= 1)" in below for below in lines[n + 1 : n + 4])


def test_rolling_sums_never_partition_rows_by_the_bare_key(spark, data):
    text = plan(incidents.quota_levels(table(spark, data, "usage_samples")))
    for part in text.split("Exchange hashpartitioning(")[1:]:
        if "_slice" not in part.split(", 4)")[0]:
            assert "Aggregate" in part.split("\n")[1]


def test_a_hot_component_is_spread(spark):
    """A component with nearly all rows still yields many window groups."""
    probes = spark.range(4000).select(
        F.col("id").alias("probe_id"),
        (F.lit(datetime(2024, 1, 1)) + F.make_interval(mins=F.col("id").cast("int"))).alias("probe_ts"),
        F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("component"),
        F.when(F.col("id") % 3 == 0, 503).otherwise(200).alias("http_status"),
        F.lit("UP").alias("body_status"),
        F.lit(None).cast("string").alias("error"),
    )
    found = incidents.probe_incidents(probes)
    hot = found.where("component = 'hot'")
    assert hot.count() == len([i for i in range(4000) if i % 3 == 0 and i % 100])
    assert hot.where("resolved_at is null").count() <= 1
    assert hot.agg(F.max(F.col("resolved_at") - F.col("created_at"))).first()[0] <= timedelta(minutes=2)


def test_newest_rows_open_the_newest_dates_only(spark, data, tmp_path):
    logs = table(spark, data, "log_events").withColumn("event_date", F.to_date("timestamp"))
    path = str(tmp_path / "logs")
    logs.repartition(1).write.partitionBy("event_date").parquet(path)
    opened = []

    def read(since):
        rows = spark.read.parquet(path)
        rows = rows if since is None else rows.where(F.col("event_date") >= F.lit(since.date())).where(F.col("timestamp") >= F.lit(since))
        pruned = plan(rows).split("PartitionFilters: [")[1].split("]")[0]
        opened.append(pruned)
        return rows

    days = {r.event_date: r["count"] for r in logs.groupBy("event_date").count().collect()}
    assert len(days) > 25
    for n in (1, 50, 90, 10**6):
        opened.clear()
        newest = reads.newest_first(read, EVENTS_AS_OF, n)
        want = logs.orderBy(F.col("timestamp").desc(), "id").limit(n)
        assert rows_of(newest.orderBy(F.col("timestamp").desc(), "id").limit(n)) == rows_of(want)
        if n < 100:
            assert len(opened) <= 4 and "event_date" in opened[-1] and "2024-01-2" in opened[-1] or "2024-01-3" in opened[-1]
    assert opened[-1] == ""  # a table with fewer rows is read whole, at last
    snapshot = snapshots.log_snapshot(spark.read.parquet(path), newest=reads.newest_first(read, EVENTS_AS_OF, 50))
    text = snapshot._jdf.queryExecution().toString()
    assert snapshot.first().total_logs == logs.count()
    assert "ReadSchema: struct<>" in text


def rows_of(df):
    return [tuple(r) for r in df.select("id", "timestamp").collect()]


def test_seven_day_reads_prune_to_their_dates(spark, data, tmp_path):
    path = str(tmp_path / "summary")
    rollups.daily_errors(table(spark, data, "mobile_telemetry_events")).write.partitionBy("snapshot_date").parquet(path)
    text = plan(snapshots.platform_top_crash_7d(spark.read.parquet(path), EVENTS_AS_OF))
    assert "snapshot_date#" in text.split("PartitionFilters: [")[1].split("]")[0] and "2024-01-25" in text


RANGED = [
    "day_window", "stats_24h", "runtime_series", "runtime_series_daily", "dash_top_screens", "dash_top_events",
    "dash_top_errors", "dash_api_latency", "performance_series", "funnel_totals", "merged_keywords", "top_errors",
    "top_screens", "slow_endpoints", "platform_perf_7d", "platform_conversion_7d", "platform_top_keyword_7d",
    "platform_top_crash_7d", "mobile_snapshot_7d", "retain_raw", "retain_history",
]


@pytest.mark.parametrize("name", RANGED)
def test_ranges_reach_the_scan(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    pushed = [part.split("]")[0] for part in text.split("PushedFilters: [")[1:]]
    assert pushed and all("GreaterThanOrEqual(ts" in filters for filters in pushed)
