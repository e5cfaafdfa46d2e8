"""KPI snapshots: seven-day platform figures, incident and log summaries, latest gauges, display labels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.functions.clock import days_back, label
from beaconlake.functions.text import clean_keyword, duration_label, fixed, uptime_label

# Placeholders shown when a seven-day window has nothing to report.
NO_KEYWORD = "N/A"
NO_CRASH = "Zero runtime exceptions captured."


def _last_seven_days(summary: DataFrame, as_of: datetime) -> DataFrame:
    first, last = days_back(as_of, 6), days_back(as_of, 0)
    return summary.where(F.col("snapshot_date").between(F.lit(first), F.lit(last)))


def platform_perf_7d(performance: DataFrame, as_of: datetime) -> DataFrame:
    """Totals, true error rate and the mean of the daily p95 values, per platform."""
    errors = F.sum("error_requests")
    rate = F.try_divide(errors.cast("double"), F.sum("total_requests")) * 100
    return (
        _last_seven_days(performance, as_of)
        .groupBy("os_platform")
        .agg(
            F.sum("total_requests").alias("total_requests"),
            errors.alias("error_requests"),
            F.coalesce(F.round(rate, 2), F.lit(0.0)).alias("error_rate"),
            F.coalesce(F.floor(F.avg("p95_ms") + 0.5), F.lit(0)).cast("bigint").alias("p95_latency_ms"),
        )
    )


def platform_conversion_7d(funnel: DataFrame, as_of: datetime) -> DataFrame:
    """Rentals per viewed cart in percent; 100 when no cart was viewed."""
    carts, rents = F.sum("cart_viewed_count"), F.sum("rent_success_count")
    rate = F.when(carts > 0, F.round(rents.cast("double") / carts * 100, 1)).otherwise(100.0)
    return (
        _last_seven_days(funnel, as_of).groupBy("os_platform").agg(rate.alias("funnel_conversion_rate"))
    )


def _first_per_platform(counts: DataFrame, name: str, count: str) -> DataFrame:
    """The most frequent name per platform; the rank filter is applied before the shuffle as well."""
    order = Window.partitionBy("os_platform").orderBy(F.col(count).desc(), F.col(name))
    return counts.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def platform_top_keyword_7d(funnel: DataFrame, as_of: datetime) -> DataFrame:
    """Most searched keyword per platform after clean-up; a daily entry without a count counts once."""
    items = _last_seven_days(funnel, as_of).select("os_platform", F.explode("top_searched_keywords").alias("item"))
    counts = (
        items.select(
            "os_platform",
            clean_keyword(F.col("item.keyword")).alias("top_keyword"),
            F.coalesce("item.count", F.lit(1)).alias("count"),
        )
        .where(F.col("top_keyword").isNotNull())
        .groupBy("os_platform", "top_keyword")
        .agg(F.sum("count").alias("keyword_count"))
    )
    return _first_per_platform(counts, "top_keyword", "keyword_count")


def platform_top_crash_7d(errors: DataFrame, as_of: datetime) -> DataFrame:
    counts = (
        _last_seven_days(errors, as_of)
        .groupBy("os_platform", F.col("error_name").alias("top_crash_name"))
        .agg(F.sum("occurrence_count").alias("top_crash_count"))
    )
    return _first_per_platform(counts, "top_crash_name", "top_crash_count")


def mobile_snapshot_7d(
    performance: DataFrame, funnel: DataFrame, errors: DataFrame, as_of: datetime, platforms: list[str]
) -> DataFrame:
    """One row per listed platform, with the stated placeholder where a part has no data; from the stored summaries."""
    joined = _listed(performance, platforms)
    for part in (
        platform_perf_7d(performance, as_of),
        platform_conversion_7d(funnel, as_of),
        platform_top_keyword_7d(funnel, as_of),
        platform_top_crash_7d(errors, as_of),
    ):
        joined = joined.join(part, "os_platform", "left")
    return _snapshot(joined)


def mobile_snapshot_of(figures: DataFrame, as_of: datetime, platforms: list[str]) -> DataFrame:
    """The same from ``daily_figures``, read once: totals, cleaned keywords and crashes are grains of one aggregation."""

    def grain(kind: str, name: Column, count: Column, **totals: Column) -> Column:
        cells = [totals.get(c, F.lit(None)).cast("bigint").alias(c) for c in ("requests", "failed", "p95", "carts", "rents")]
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"), count.cast("bigint").alias("n"), *cells)

    nothing = F.lit(None).cast("string")
    totals = grain(
        "total", nothing, F.lit(0), requests=F.col("total_requests"), failed=F.col("error_requests"), p95=F.col("p95_ms"),
        carts=F.col("cart_viewed_count"), rents=F.col("rent_success_count"),
    )
    keywords = F.transform(
        "top_searched_keywords", lambda item: grain("keyword", clean_keyword(item["keyword"]), F.coalesce(item["count"], F.lit(1)))
    )
    crash = F.when(F.col("error_name").isNotNull(), grain("crash", F.col("error_name"), F.col("occurrence_count")))
    grains = _last_seven_days(figures, as_of).select("os_platform", F.inline(F.filter(F.concat(F.array(totals, crash), keywords), lambda g: g.isNotNull())))
    sums = grains.groupBy("os_platform", "kind", "name").agg(
        *(F.sum(c).alias(c) for c in ("n", "requests", "failed", "carts", "rents", "p95")), F.count("p95").alias("days")
    )

    def first(kind: str) -> Column:
        named = (F.col("kind") == kind) & F.col("name").isNotNull()
        return F.min(F.when(named, F.struct(F.negative("n").alias("order"), "name", "n")))

    carts, rents = F.sum("carts"), F.sum("rents")
    rate = F.try_divide(F.sum("failed").cast("double"), F.sum("requests")) * 100
    parts = sums.groupBy("os_platform").agg(
        F.sum("requests").alias("total_requests"),
        F.coalesce(F.round(rate, 2), F.lit(0.0)).alias("error_rate"),
        F.floor(F.try_divide(F.sum("p95").cast("double"), F.sum("days")) + 0.5).cast("bigint").alias("p95_latency_ms"),
        F.when(carts > 0, F.round(rents.cast("double") / carts * 100, 1)).alias("funnel_conversion_rate"),
        first("keyword")["name"].alias("top_keyword"),
        first("crash").alias("crash"),
    )
    parts = parts.select("*", F.col("crash.name").alias("top_crash_name"), F.col("crash.n").alias("top_crash_count"))
    return _snapshot(_listed(figures, platforms).join(parts, "os_platform", "left"))


def _listed(df: DataFrame, platforms: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(name,) for name in platforms], "os_platform string")


def _snapshot(joined: DataFrame) -> DataFrame:
    return joined.select(
        "os_platform",
        F.coalesce("total_requests", F.lit(0)).alias("total_requests"),
        F.coalesce("error_rate", F.lit(0.0)).alias("error_rate"),
        F.coalesce("p95_latency_ms", F.lit(0)).alias("p95_latency_ms"),
        F.coalesce("funnel_conversion_rate", F.lit(100.0)).alias("funnel_conversion_rate"),
        F.coalesce("top_keyword", F.lit(NO_KEYWORD)).alias("top_keyword"),
        F.coalesce("top_crash_name", F.lit(NO_CRASH)).alias("top_crash_name"),
        F.coalesce("top_crash_count", F.lit(0)).alias("top_crash_count"),
    )


def incident_summary(incidents: DataFrame) -> DataFrame:
    """Active count, clearance rate in percent and mean time to resolve, in one pass.

    Each resolved incident contributes whole minutes; an incident without a resolution time contributes none.
    """
    resolved = F.col("status") == "resolved"
    seconds = F.unix_timestamp("resolved_at") - F.unix_timestamp("created_at")
    whole_minutes = ((seconds - seconds % 60) / 60).cast("bigint")
    mean = F.floor(F.avg(F.when(resolved, whole_minutes)) + 0.5)
    rate = F.try_divide(F.count_if(resolved).cast("double"), F.count("*")) * 100
    return incidents.agg(
        F.count_if(F.col("status") == "active").alias("active_incidents"),
        F.coalesce(F.round(rate, 1), F.lit(100.0)).alias("clearance_rate"),
        mean.alias("mttr_minutes"),
    ).select("active_incidents", "clearance_rate", "mttr_minutes", duration_label(F.col("mttr_minutes")).alias("avg_mttr"))


def latest_incident_per_component(incidents: DataFrame, components: list[str]) -> DataFrame:
    """Newest incident of each listed component, in list order; equal times fall to the smaller id.

    Two hash aggregations instead of a per-component sort: the newest time per component first (at most one row per
    listed component, so it can be broadcast), then the smallest id among the rows that carry it.
    """
    listed = incidents.where(F.col("component").isin(*components))
    newest = listed.groupBy("component").agg(F.max("created_at").alias("created_at"))
    position = F.array_position(F.array(*map(F.lit, components)), F.col("component"))
    return (
        listed.join(F.broadcast(newest), ["component", "created_at"])
        .groupBy("component", "created_at")
        .agg(F.min(F.struct("id", "status", "title")).alias("first"))
        .select(
            "component",
            "first.status",
            "first.title",
            label(F.col("created_at"), "dd/MM HH:mm UTC").alias("created_at"),
        )
        .orderBy(position)
    )


def recent_logs(logs: DataFrame, n: int = 50) -> DataFrame:
    return logs.orderBy(F.col("timestamp").desc(), "id").limit(n)


def log_snapshot(logs: DataFrame, shown: int = 5, newest: DataFrame | None = None) -> DataFrame:
    """Errors and distinct traces among the newest 50 lines, the first lines themselves, and the total of all lines.

    ``newest`` are rows that hold the newest 50, where a stored table can be read from its newest dates. The total is a
    count that reads no column.
    """
    newest = recent_logs(logs if newest is None else newest)
    line = F.struct(F.negative(F.unix_micros("timestamp")).alias("age"), "id", "platform", "level", "message")
    ordered = F.slice(F.sort_array(F.collect_list(line)), 1, shown)
    total = logs.agg(F.count("*").alias("total_logs"))
    return newest.agg(
        F.count_if(F.col("level").isin("ERROR", "FATAL")).alias("error_count"),
        F.count_distinct(F.nullif("traceId", F.lit(""))).alias("active_traces"),
        ordered.alias("recent_logs"),
    ).select(total.scalar().alias("total_logs"), "error_count", "active_traces", "recent_logs")


def log_platform_share(logs: DataFrame, shown: int = 5) -> DataFrame:
    """Percent of the shown lines that come from each platform."""
    lines = recent_logs(logs, shown)

    def share(platform: str) -> Column:
        part = F.count_if(F.col("platform") == platform) * 100 / F.greatest(F.count("*"), F.lit(1))
        return F.floor(part + 0.5).cast("bigint").alias(f"pct_{platform}")

    return lines.agg(share("backend"), share("android"), share("ios"))


# Fixed value: characters a rendered log line has room for.
LINE_WIDTH = 66


def log_lines(logs: DataFrame) -> DataFrame:
    """One display line per log row: '[platform::trace] ' prefix, message cut to the remaining width, time of day."""
    trace = F.coalesce(F.nullif(F.substring("traceId", 1, 4), F.lit("")), F.lit("----"))
    prefix = F.concat(F.lit("["), F.col("platform"), F.lit("::"), trace, F.lit("] "))
    room = F.lit(LINE_WIDTH) - F.length(prefix)
    cut = F.concat(F.substring(F.col("message"), F.lit(1), room - 3), F.lit("..."))
    message = F.when(F.length("message") > room, cut).otherwise(F.col("message"))
    return logs.select(
        "id", "level", F.concat(prefix, message).alias("line"), label(F.col("timestamp"), "HH:mm:ss").alias("at")
    )


def scale_ratios(history: DataFrame) -> DataFrame:
    """Utilisation, media density and engagement of each snapshot row, as display text."""

    def ratio(top: str, bottom: str, factor: int, places: int) -> Column:
        value = F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom) * factor).otherwise(0.0)
        return fixed(value, places)

    return history.select(
        "*",
        F.concat(ratio("loans", "books", 100, 1), F.lit("%")).alias("utilization"),
        ratio("review_images", "reviews", 1, 2).alias("media_density"),
        ratio("reviews", "users", 1, 2).alias("engagement"),
    )


def latest_scale(history: DataFrame) -> DataFrame:
    newest = history.orderBy(F.col("timestamp").desc(), F.col("books").desc(), F.col("loans").desc()).limit(1)
    return scale_ratios(newest)


# Gauge names and the columns that store them.
GAUGES = {
    "process.cpu.usage": "cpu_usage",
    "jvm.memory.used": "jvm_memory_used",
    "spring.security.http.secured.requests": "http_requests",
    "hikaricp.connections.active": "active_db_connections",
    "process.uptime": "uptime",
}


def latest_runtime(gauges: DataFrame) -> DataFrame:
    return gauges.orderBy(F.col("timestamp").desc(), F.col("http_requests").desc()).limit(1)


def latest_runtime_unpivot(gauges: DataFrame) -> DataFrame:
    """The newest poll as (metric_name, metric_value) rows; a gauge that failed reads 0."""
    wide = latest_runtime(gauges).select(
        *(F.coalesce(F.col(column), F.lit(0.0)).alias(name) for name, column in GAUGES.items())
    )
    return wide.unpivot([], [f"`{name}`" for name in GAUGES], "metric_name", "metric_value")


def runtime_labels(gauges: DataFrame) -> DataFrame:
    """Display text of each poll: uptime, cpu, heap and request count."""

    def value(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0.0))

    return gauges.select(
        "timestamp",
        uptime_label(value("uptime")).alias("uptime"),
        F.concat(fixed(value("cpu_usage") * 100, 1), F.lit("%")).alias("cpu"),
        F.concat(F.floor(value("jvm_memory_used") / 1024 / 1024).cast("string"), F.lit("M")).alias("heap"),
        F.format_number(F.floor(value("http_requests")), 0).alias("requests"),
    )


def status_labels(incidents: DataFrame, logs: DataFrame) -> DataFrame:
    """Status words of the incident and log panels."""
    recent_errors = recent_logs(logs).agg(F.count_if(F.col("level").isin("ERROR", "FATAL")).alias("errors"))
    active = incidents.agg(F.count_if(F.col("status") == "active").alias("active"))
    return active.select(
        F.when(F.col("active") > 0, "SYSTEM DEGRADED").otherwise("ALL SYSTEMS OPERATIONAL").alias("incident_status"),
        F.when(recent_errors.scalar() > 0, "ERRORS").otherwise("HEALTHY").alias("log_status"),
    )
