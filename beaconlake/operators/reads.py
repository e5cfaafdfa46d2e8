"""Range-parameterised reads over the history and summary tables.

Top-n results carry a total order: the stated order first, then the grouping keys ascending.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions.clock import DAY, days_back, is_last_day, parse_days, utc, within
from beaconlake.functions.clock import label as label_of
from beaconlake.operators.rollups import KEYWORDS_TYPE, keyword_items, top_keywords


def _newest(column: str) -> Column:
    return F.max(column).alias(column)


def stats_series(history: DataFrame, as_of: datetime, window: str = "7", users_offset: int = 0) -> DataFrame:
    """Cumulative counters by hour for '24h', else by day for the newest n days that have rows."""
    if is_last_day(window):
        rows = history.where(F.col("timestamp") > F.lit(utc(as_of) - DAY))
        label, newest, limit = label_of(F.col("timestamp"), "HH:00"), F.col("timestamp").desc(), 24
    else:
        rows, limit = history, parse_days(window)
        label, newest = label_of(F.col("timestamp"), "yyyy-MM-dd"), F.col("day").desc()
    return (
        rows.groupBy(label.alias("day"))
        .agg(
            _newest("books"),
            (F.max("users") + users_offset).alias("users"),
            _newest("loans"),
            _newest("reviews"),
            _newest("review_images"),
            _newest("timestamp"),
        )
        .orderBy(newest, "day")
        .limit(limit)
    )


def runtime_series(gauges: DataFrame, as_of: datetime, window: str = "7", conn_offset: int = 0) -> DataFrame:
    """Gauge maxima by minute of day for '24h', else by calendar day of the last n days."""
    if is_last_day(window):
        label, since = label_of(F.col("timestamp"), "HH:mm"), utc(as_of) - DAY
    else:
        label = label_of(F.col("timestamp"), "MM-dd")
        since = utc(as_of) - parse_days(window.lower().replace("d", "", 1)) * DAY
    return (
        gauges.where(F.col("timestamp") > F.lit(since))
        .groupBy(label.alias("time_label"))
        .agg(
            F.round(F.max("cpu_usage") * 100, 1).alias("cpu"),
            F.round(F.max("jvm_memory_used") / 1024 / 1024, 0).alias("memory"),
            F.max("http_requests").alias("requests"),
            (F.max("active_db_connections") + conn_offset).alias("db_conn"),
            F.round(F.max("uptime") / 3600, 1).alias("uptime"),
            F.max("timestamp").alias("raw_time"),
        )
        .orderBy(F.col("raw_time").desc(), "time_label")
    )


def _recent(summary: DataFrame, as_of: datetime, window: str) -> DataFrame:
    return summary.where(F.col("snapshot_date") >= F.lit(days_back(as_of, parse_days(window))))


def performance_series(performance: DataFrame, as_of: datetime, window: str = "7") -> DataFrame:
    rate = F.try_divide(F.col("error_requests").cast("double"), F.col("total_requests")) * 100
    return (
        _recent(performance, as_of, window)
        .select(
            "snapshot_date",
            "os_platform",
            "p50_ms",
            "p95_ms",
            "p99_ms",
            F.col("total_requests").alias("total_calls"),
            F.round(rate, 2).alias("error_rate"),
        )
        .orderBy("snapshot_date", "os_platform")
    )


def keyword_totals(funnel: DataFrame) -> DataFrame:
    """Daily keyword arrays flattened and summed per (platform, keyword)."""
    return (
        funnel.select("os_platform", F.explode("top_searched_keywords").alias("item"))
        .groupBy("os_platform", F.col("item.keyword").alias("keyword"))
        .agg(F.sum("item.count").alias("count"))
    )


def merged_keywords(funnel: DataFrame, as_of: datetime, window: str = "7") -> DataFrame:
    return top_keywords(keyword_totals(_recent(funnel, as_of, window)), ["os_platform"])


def funnel_totals(funnel: DataFrame, as_of: datetime, window: str = "7") -> DataFrame:
    """Totals and most searched keywords of each platform, from one read of the daily rows.

    A day gives one row with its counts and one for each of its keywords; both are summed by one aggregation. What meets
    for a platform after that are its distinct daily keywords, five a day at most.
    """
    names = {
        "scan_opened_count": "total_scan_open", "scan_success_count": "total_scan_success", "scan_miss_count": "total_scan_miss",
        "cart_viewed_count": "total_cart_view", "rent_success_count": "total_rent_success",
    }

    def grain(searched: bool, keyword: Column, counts: dict[str, Column], count: Column) -> Column:
        cells = [counts.get(name, F.lit(0)).cast("bigint").alias(name) for name in names]
        return F.struct(F.lit(searched).alias("searched"), keyword.alias("keyword"), *cells, count.cast("bigint").alias("count"))

    day = grain(False, F.lit(None).cast("string"), {name: F.col(name) for name in names}, F.lit(0))
    listed = F.coalesce("top_searched_keywords", F.array().cast(KEYWORDS_TYPE))
    keywords = F.transform(listed, lambda item: grain(True, item["keyword"], {}, item["count"]))
    grains = _recent(funnel, as_of, window).select("os_platform", F.inline(F.concat(F.array(day), keywords)))
    sums = grains.groupBy("os_platform", "searched", "keyword").agg(*(F.sum(name).alias(name) for name in [*names, "count"]))
    found = F.when(F.col("searched"), F.struct(F.negative("count").alias("order"), "keyword", "count"))
    best = F.slice(F.sort_array(F.collect_list(found)), 1, 5)
    totals = sums.groupBy("os_platform").agg(*(F.sum(name).alias(total) for name, total in names.items()), best.alias("best"))
    return totals.select("os_platform", *names.values(), keyword_items("best").alias("top_searched_keywords"))


def _top_sums(summary: DataFrame, keys: list[str], value: str, total: str, n: int) -> DataFrame:
    return (
        summary.groupBy(*keys).agg(F.sum(value).alias(total)).orderBy(F.col(total).desc(), *keys).limit(n)
    )


def top_errors(errors: DataFrame, as_of: datetime, window: str = "7") -> DataFrame:
    recent = _recent(errors, as_of, window)
    return _top_sums(recent, ["error_name", "os_platform"], "occurrence_count", "total_occurrences", 10)


def top_screens(screens: DataFrame, as_of: datetime, window: str = "7") -> DataFrame:
    recent = _recent(screens, as_of, window)
    return _top_sums(recent, ["screen_name", "os_platform"], "visit_count", "total_views", 12)


def slow_endpoints(endpoints: DataFrame, as_of: datetime, window: str = "7") -> DataFrame:
    """Unweighted mean of daily means: a quiet day counts as much as a busy one."""
    return (
        _recent(endpoints, as_of, window)
        .groupBy("endpoint", "method")
        .agg(F.round(F.avg("avg_latency_ms"), 2).alias("latency_ms"), F.sum("call_count").alias("total_calls"))
        .orderBy(F.col("latency_ms").desc(), "endpoint", "method")
        .limit(8)
    )


def latest_incidents(incidents: DataFrame, n: int = 50) -> DataFrame:
    """Active incidents first, newest first within each group."""
    resolved = F.when(F.col("status") == "active", 0).otherwise(1)
    return incidents.orderBy(resolved, F.col("created_at").desc(), "id").limit(n)


def newest_first(read: Callable[[datetime | None], DataFrame], as_of: datetime, n: int, first: timedelta = DAY) -> DataFrame:
    """Rows of a dated table from so far back that ``n`` of them are found, opening dates from the newest backwards.

    ``read`` gives the rows at or after a time, all of them for None, with a range that its scan can skip files by. The range
    is doubled until it holds enough rows; what is counted stops at ``n``. Rows later than ``as_of`` count as newest.
    """
    span = first
    for _ in range(DOUBLINGS):
        rows = read(utc(as_of) - span)
        if rows.limit(n).count() >= n:
            return rows
        span *= 2
    return read(None)


#: From a day to more than ten years; then the whole table is read.
DOUBLINGS = 13


# Dashboard reads over raw telemetry of the last 24 hours.


def _last_day(raw: DataFrame, as_of: datetime) -> DataFrame:
    return within(raw, utc(as_of) - DAY, None)


def _top_events(events: DataFrame, as_of: datetime, kind: str, names: dict[str, str], n: int = 5) -> DataFrame:
    keys = [F.col(source).alias(target) for source, target in names.items()]
    return (
        _last_day(events, as_of)
        .where(F.col("event_type") == kind)
        .groupBy(*keys)
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), *names.values())
        .limit(n)
    )


def dash_top_screens(events: DataFrame, as_of: datetime) -> DataFrame:
    return _top_events(events, as_of, "SCREEN_VIEW", {"event_name": "screen_name"})


def dash_top_events(events: DataFrame, as_of: datetime) -> DataFrame:
    return _top_events(events, as_of, "CUSTOM_EVENT", {"event_name": "event_name"})


def dash_top_errors(events: DataFrame, as_of: datetime) -> DataFrame:
    """Per error name and message; errors without a message form their own group."""
    return _top_events(events, as_of, "ERROR", {"event_name": "error_type", "error_message": "message"})


def dash_api_latency(metrics: DataFrame, as_of: datetime) -> DataFrame:
    """Unlike the daily rollup, every status from 200 up to 399 is a success here."""
    status = F.col("status_code")
    return (
        _last_day(metrics, as_of)
        .groupBy("endpoint")
        .agg(
            F.avg("latency_ms").alias("avg_latency_ms"),
            F.count("*").alias("total_requests"),
            (F.count_if((status >= 200) & (status < 400)) * 100.0 / F.count("*")).cast("double").alias("success_rate"),
        )
        .orderBy(F.col("avg_latency_ms").desc(), "endpoint")
    )


def live_tail(events: DataFrame, n: int = 50) -> DataFrame:
    """Newest events with their attributes as a map; NULL where the text is not a JSON object.

    Over a stored table, pass what ``newest_first`` gives.
    """
    newest = events.orderBy(F.col("timestamp").desc(), "id").limit(n)
    return newest.withColumn("attributes", F.from_json("attributes", "map<string, string>"))
