"""Named queries: each takes (spark, data_dir), reads the given tables whole and returns a DataFrame.

Dates, times and nested values leave as text, the form the stored tables and the JSON edge use.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.functions import clock, text
from beaconlake.operators import ci, incidents, reads, rollups, sinks, snapshots
from beaconlake.plans import jobs
from beaconlake.plans.publish import Store
from beaconlake.session import run_dir, written
from beaconlake.sources import payloads
from beaconlake.sources.derived import stream, table
from beaconlake.streaming import incidents as incident_streams
from beaconlake.streaming import ingest
from beaconlake.streaming import quota as quota_streams
from beaconlake.streaming import rollups as rollup_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The test tables are fixed in time; queries look back from the end of each.
EVENTS_AS_OF = datetime(2024, 1, 31)
ORDERS_AS_OF = datetime(2001, 8, 2)
HISTORY_AS_OF = datetime(2024, 2, 10)
ALL_DAYS = "30"

COMPONENTS = ["api-probe", "ci"]
REPOSITORIES = ["acme/mobile", "acme/tablet", "acme/api", "acme/reports", "acme/docs"]
OWNER = "acme"
LANGUAGES: ci.LanguageRules = [
    (("%API%", "%reports%"), "Python"),
    (("%mobile%", "%tablet%"), "Dart"),
]
PLATFORMS = ["Android", "iOS"]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# Ranges of the reads below, put on the scan as well: the last day, the 30 dates back from today, and the last 7 dates.
LAST_DAY = (EVENTS_AS_OF - clock.DAY, None)
LAST_MONTH = (clock.utc_midnight(clock.days_back(EVENTS_AS_OF, int(ALL_DAYS))), None)
LAST_WEEK = (clock.utc_midnight(clock.days_back(EVENTS_AS_OF, 6)), clock.midnight(EVENTS_AS_OF) + clock.DAY)


def _metrics(spark: SparkSession, data: str, since=None, until=None) -> DataFrame:
    return table(spark, data, "mobile_telemetry_api_metrics", since, until)


def _events(spark: SparkSession, data: str, since=None, until=None) -> DataFrame:
    return table(spark, data, "mobile_telemetry_events", since, until)


def _funnel(spark: SparkSession, data: str, since=None, until=None) -> DataFrame:
    return rollups.daily_funnel(_events(spark, data, since, until))


def as_text(df: DataFrame) -> DataFrame:
    """Render dates, timestamps, arrays and structs as text."""

    def render(field) -> Column:
        kind = field.dataType.typeName()
        if kind == "date":
            value = F.date_format(field.name, "yyyy-MM-dd")
        elif kind == "timestamp":
            value = clock.stamp(F.col(field.name))
        elif kind in ("array", "struct", "map"):
            value = F.to_json(field.name, {"ignoreNullFields": "false"})
        else:
            return F.col(field.name)
        return value.alias(field.name)

    return df.select(*map(render, df.schema.fields))


# Rollups


@query
def day_window(spark, data):
    day = clock.yesterday(EVENTS_AS_OF)
    return rollups.day_window(_events(spark, data, *day), *day)


@query
def daily_api_performance(spark, data):
    return as_text(rollups.daily_api_performance(_metrics(spark, data)))


@query
def daily_endpoint_latency(spark, data):
    return as_text(rollups.daily_endpoint_latency(_metrics(spark, data)))


@query
def normalize_endpoint(spark, data):
    endpoint = text.normalize_endpoint(F.col("endpoint")).alias("endpoint")
    return _metrics(spark, data).groupBy(endpoint).agg(F.count("*").alias("calls"))


@query
def daily_funnel(spark, data):
    return as_text(_funnel(spark, data))


@query
def daily_top_keywords(spark, data):
    return as_text(rollups.daily_top_keywords(_events(spark, data)))


@query
def daily_errors(spark, data):
    return as_text(rollups.daily_errors(_events(spark, data)))


@query
def daily_screens(spark, data):
    return as_text(rollups.daily_screens(_events(spark, data)))


# Range reads


@query
def stats_24h(spark, data):
    return as_text(reads.stats_series(table(spark, data, "stats_history", *LAST_DAY), EVENTS_AS_OF, "24h"))


@query
def stats_daily(spark, data):
    return as_text(reads.stats_series(table(spark, data, "stats_history"), EVENTS_AS_OF, "30D", users_offset=500))


@query
def runtime_series(spark, data):
    return as_text(reads.runtime_series(table(spark, data, "app_metrics2", *LAST_DAY), EVENTS_AS_OF, "24h", conn_offset=1))


@query
def runtime_series_daily(spark, data):
    return as_text(reads.runtime_series(table(spark, data, "app_metrics2", EVENTS_AS_OF - 30 * clock.DAY), EVENTS_AS_OF, "30d"))


@query
def performance_series(spark, data):
    daily = rollups.daily_api_performance(_metrics(spark, data, *LAST_MONTH))
    return as_text(reads.performance_series(daily, EVENTS_AS_OF, ALL_DAYS))


@query
def funnel_totals(spark, data):
    return as_text(reads.funnel_totals(_funnel(spark, data, *LAST_MONTH), EVENTS_AS_OF, ALL_DAYS))


@query
def merged_keywords(spark, data):
    return as_text(reads.merged_keywords(_funnel(spark, data, *LAST_MONTH), EVENTS_AS_OF, ALL_DAYS))


@query
def top_errors(spark, data):
    return reads.top_errors(rollups.daily_errors(_events(spark, data, *LAST_MONTH)), EVENTS_AS_OF, ALL_DAYS)


@query
def top_screens(spark, data):
    return reads.top_screens(rollups.daily_screens(_events(spark, data, *LAST_MONTH)), EVENTS_AS_OF, ALL_DAYS)


@query
def slow_endpoints(spark, data):
    return reads.slow_endpoints(rollups.daily_endpoint_latency(_metrics(spark, data, *LAST_MONTH)), EVENTS_AS_OF, ALL_DAYS)


@query
def latest_incidents(spark, data):
    return as_text(reads.latest_incidents(table(spark, data, "incidents")))


@query
def dash_top_screens(spark, data):
    return reads.dash_top_screens(_events(spark, data, *LAST_DAY), EVENTS_AS_OF)


@query
def dash_top_events(spark, data):
    return reads.dash_top_events(_events(spark, data, *LAST_DAY), EVENTS_AS_OF)


@query
def dash_top_errors(spark, data):
    return reads.dash_top_errors(_events(spark, data, *LAST_DAY), EVENTS_AS_OF)


@query
def dash_api_latency(spark, data):
    return reads.dash_api_latency(_metrics(spark, data, *LAST_DAY), EVENTS_AS_OF)


@query
def live_tail(spark, data):
    return as_text(reads.live_tail(reads.newest_first(lambda since: _events(spark, data, since), EVENTS_AS_OF, 50)))


# CI reads


def _deliveries(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "github_app_metrics")


@query
def commit_activity(spark, data):
    return ci.commit_activity(_deliveries(spark, data), ORDERS_AS_OF, "9999d")


@query
def commit_activity_weekly(spark, data):
    return ci.commit_activity(_deliveries(spark, data), ORDERS_AS_OF, "90d")


@query
def code_growth(spark, data):
    return ci.code_growth(_deliveries(spark, data), ORDERS_AS_OF, "all_time")


@query
def repo_activity(spark, data):
    return ci.repo_activity(_deliveries(spark, data), ORDERS_AS_OF, "all_time")


@query
def language_dist(spark, data):
    return ci.language_dist(_deliveries(spark, data), ORDERS_AS_OF, LANGUAGES, "all_time")


@query
def github_metrics(spark, data):
    return ci.github_metrics(_deliveries(spark, data), ORDERS_AS_OF, LANGUAGES, "all_time")


@query
def latest_per_repo(spark, data):
    return as_text(ci.latest_per_repo(_deliveries(spark, data), REPOSITORIES))


@query
def github_totals(spark, data):
    return ci.github_totals(_deliveries(spark, data))


@query
def latest_push(spark, data):
    return ci.latest_push(_deliveries(spark, data), OWNER)


# Snapshots and KPIs


@query
def date_span_7d(spark, data):
    day = clock.event_date(F.col("timestamp"))
    per_day = _events(spark, data).groupBy(day.alias("target_date")).agg(F.count("*").alias("event_count"))
    return as_text(per_day.withColumn("display_span", clock.seven_day_span(F.col("target_date"))))


@query
def platform_perf_7d(spark, data):
    return snapshots.platform_perf_7d(rollups.daily_api_performance(_metrics(spark, data, *LAST_WEEK)), EVENTS_AS_OF)


@query
def platform_conversion_7d(spark, data):
    return snapshots.platform_conversion_7d(_funnel(spark, data, *LAST_WEEK), EVENTS_AS_OF)


@query
def platform_top_keyword_7d(spark, data):
    return snapshots.platform_top_keyword_7d(_funnel(spark, data, *LAST_WEEK), EVENTS_AS_OF)


@query
def platform_top_crash_7d(spark, data):
    return snapshots.platform_top_crash_7d(rollups.daily_errors(_events(spark, data, *LAST_WEEK)), EVENTS_AS_OF)


@query
def mobile_snapshot_7d(spark, data):
    figures = rollups.daily_figures(_metrics(spark, data, *LAST_WEEK), _events(spark, data, *LAST_WEEK))
    return snapshots.mobile_snapshot_of(figures, EVENTS_AS_OF, PLATFORMS)


def _incident_summary(spark: SparkSession, data: str) -> DataFrame:
    return snapshots.incident_summary(table(spark, data, "incidents"))


@query
def incident_active_count(spark, data):
    return _incident_summary(spark, data).select("active_incidents")


@query
def incident_clearance_rate(spark, data):
    return _incident_summary(spark, data).select("clearance_rate")


@query
def incident_mttr(spark, data):
    return _incident_summary(spark, data).select("mttr_minutes", "avg_mttr")


@query
def latest_incident_per_component(spark, data):
    return snapshots.latest_incident_per_component(table(spark, data, "incidents"), COMPONENTS)


def _newest_logs(spark: SparkSession, data: str) -> DataFrame:
    """Lines of the newest dates that hold the 50 lines a panel shows."""
    return reads.newest_first(lambda since: table(spark, data, "log_events", since), EVENTS_AS_OF, 50)


@query
def log_snapshot(spark, data):
    lines = F.transform("recent_logs", lambda line: line["id"])
    found = snapshots.log_snapshot(table(spark, data, "log_events"), newest=_newest_logs(spark, data))
    return as_text(found.withColumn("recent_logs", lines))


@query
def log_platform_share(spark, data):
    return snapshots.log_platform_share(_newest_logs(spark, data))


@query
def log_lines(spark, data):
    return snapshots.log_lines(table(spark, data, "log_events"))


@query
def latest_scale(spark, data):
    return as_text(snapshots.latest_scale(table(spark, data, "stats_history")))


@query
def latest_runtime_unpivot(spark, data):
    return snapshots.latest_runtime_unpivot(table(spark, data, "app_metrics2"))


@query
def runtime_labels(spark, data):
    return as_text(snapshots.runtime_labels(table(spark, data, "app_metrics2")))


@query
def relative_time(spark, data):
    age = text.relative_time(F.col("created_at"), ORDERS_AS_OF).alias("pulse")
    return table(spark, data, "incidents").select("id", age)


@query
def log_relative_time(spark, data):
    age = text.log_relative_time(F.col("timestamp"), EVENTS_AS_OF).alias("sync")
    return table(spark, data, "log_events").select("id", age)


@query
def humanize_count(spark, data):
    spent = table(spark, data, "usage_samples").select("sample_id", (F.col("rows_read") * 37).alias("n"))
    return spent.withColumn("label", text.humanize_count(F.col("n")))


@query
def status_labels(spark, data):
    return snapshots.status_labels(table(spark, data, "incidents"), _newest_logs(spark, data))


@query
def keyword_cleanup(spark, data):
    quoted = F.concat(F.lit(' "“'), F.col("message"), F.lit("”' "))
    display = text.display_keyword(F.when(F.col("level") != "FATAL", quoted)).alias("keyword")
    return table(spark, data, "log_events").select("id", display)


# Incident lifecycles


@query
def ci_incidents(spark, data):
    return as_text(incidents.ci_incidents(incidents.ci_transitions(table(spark, data, "ci_runs"))))


@query
def probe_classify(spark, data):
    classified = incidents.probe_classify(table(spark, data, "health_probes"))
    return classified.select("probe_id", "component", "problem")


@query
def probe_incidents(spark, data):
    return as_text(incidents.probe_incidents(table(spark, data, "health_probes")))


@query
def quota_levels(spark, data):
    levels = incidents.quota_levels(table(spark, data, "usage_samples"))
    return levels.select("sample_id", "resource", "rows_read_24h", "level")


def _levels(spark: SparkSession, data: str) -> DataFrame:
    """Quota levels as a stored table: the folds read them more than once."""
    return written(incidents.quota_levels(table(spark, data, "usage_samples")), "levels")


@query
def quota_incidents(spark, data):
    return as_text(incidents.quota_incidents(_levels(spark, data)))


@query
def notification_outbox(spark, data):
    runs, probes = table(spark, data, "ci_runs"), table(spark, data, "health_probes")
    return as_text(incidents.notification_outbox(runs, probes, _levels(spark, data)))


@query
def active_incident_alert(spark, data):
    return as_text(incidents.active_incident_alert(table(spark, data, "incidents"), "api-probe", ORDERS_AS_OF))


# Sinks


@query
def upsert_full(spark, data):
    metrics = _metrics(spark, data)
    stored = rollups.daily_endpoint_latency(metrics.where("platform = 'Android'"))
    rerun = rollups.daily_endpoint_latency(metrics.where("method = 'GET'"))
    return as_text(sinks.upsert_full(stored, rerun, ["snapshot_date", "endpoint", "method"]))


def _incoming_incidents(spark: SparkSession, data: str) -> DataFrame:
    """Known ids with a new message, level FATAL; unknown ids for level CRITICAL."""
    stored = table(spark, data, "incidents").where("level in ('FATAL', 'CRITICAL')")
    known = F.col("level") == "FATAL"
    return (
        stored.withColumn("id", F.when(known, F.col("id")).otherwise(F.concat("id", F.lit("-new"))))
        .withColumn("message", F.concat(F.lit("breach "), F.col("title")))
        .withColumn("status", F.lit("active"))
    )


@query
def upsert_partial(spark, data):
    stored = table(spark, data, "incidents")
    return as_text(sinks.upsert_partial(stored, _incoming_incidents(spark, data), ["id"], ["message"]))


@query
def insert_or_replace(spark, data):
    return as_text(sinks.insert_or_replace(table(spark, data, "incidents"), _incoming_incidents(spark, data)))


@query
def conditional_update(spark, data):
    return as_text(sinks.resolve_component(table(spark, data, "incidents"), "api-probe", ORDERS_AS_OF))


@query
def insert_incident(spark, data):
    grown = sinks.insert_incident(
        table(spark, data, "incidents"), "INFRA", "api-probe", "CRITICAL", "Health check failed",
        "Connection timeout (5s) - test", ORDERS_AS_OF,
    )
    v4 = F.col("id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return as_text(grown.withColumn("id", F.when(v4, "uuid").otherwise(F.col("id"))))


@query
def retain_raw(spark, data):
    since = EVENTS_AS_OF - 3 * clock.DAY
    kept = [
        sinks.retain_raw(table(spark, data, f"mobile_telemetry_{kind}", since, undated=True), EVENTS_AS_OF)
        .select(F.lit(name).alias("table_name"), "id", "timestamp")
        for name, kind in (("events", "events"), ("metrics", "api_metrics"))
    ]
    return kept[0].unionByName(kept[1])


@query
def retain_history(spark, data):
    kept = sinks.retain_history(table(spark, data, "stats_history", HISTORY_AS_OF - 30 * clock.DAY, undated=True), HISTORY_AS_OF)
    return as_text(kept.select("timestamp", "books", "users"))


# Ingest: payload text is built from the tables, then parsed back.


def event_bodies(spark: SparkSession, data: str, read: Callable = table) -> DataFrame:
    """Android sends snake_case, iOS camelCase; some payloads lack an optional or a required field."""
    e = read(spark, data, "mobile_telemetry_events")
    android = F.col("platform") == "Android"
    signup, rent = F.col("event_name") == "USER_SIGNUP", F.col("event_name") == "BOOK_RENT_ACTION"
    attributes = F.from_json("attributes", "struct<query_text: string, trigger_source: string, message: string>")
    body = F.to_json(
        F.struct(
            "id",
            F.when(~rent, F.col("timestamp")).alias("timestamp"),
            "platform",
            F.when(android, F.col("event_type")).alias("event_type"),
            F.when(~android, F.col("event_type")).alias("eventType"),
            F.when(android & ~signup, F.col("event_name")).alias("event_name"),
            F.when(~android & ~signup, F.col("event_name")).alias("eventName"),
            F.when(android, F.col("error_message")).alias("error_message"),
            F.when(~android, F.col("error_message")).alias("errorMessage"),
            F.when(android, F.col("app_version")).alias("app_version"),
            attributes.alias("attributes"),
        )
    )
    broken = F.col("error_message") == "E4"
    return e.select(F.when(broken, F.concat(F.lit("{"), body)).otherwise(body).alias("body"))


def metric_bodies(spark: SparkSession, data: str, read: Callable = table) -> DataFrame:
    android = F.col("platform") == "Android"
    known = F.col("status_code") != 201
    body = F.to_json(
        F.struct(
            "id",
            "timestamp",
            "platform",
            "endpoint",
            "method",
            F.when(android & known, F.col("status_code")).alias("status_code"),
            F.when(~android & known, F.col("status_code")).alias("statusCode"),
            F.when(android, F.col("latency_ms")).alias("latency_ms"),
            F.when(~android, F.col("latency_ms")).alias("latencyMs"),
        )
    )
    return read(spark, data, "mobile_telemetry_api_metrics").select(body.alias("body"))


@query
def ingest_events(spark, data):
    return payloads.ingest_events(event_bodies(spark, data), EVENTS_AS_OF).accepted


@query
def ingest_events_quarantine(spark, data):
    rejected = payloads.ingest_events(event_bodies(spark, data), EVENTS_AS_OF).quarantine
    return rejected.groupBy("reason").agg(F.count("*").alias("rejected"))


@query
def ingest_api_metrics(spark, data):
    return payloads.ingest_api_metrics(metric_bodies(spark, data), EVENTS_AS_OF).accepted


@query
def ingest_api_metrics_quarantine(spark, data):
    rejected = payloads.ingest_api_metrics(metric_bodies(spark, data), EVENTS_AS_OF).quarantine
    return rejected.groupBy("reason").agg(F.count("*").alias("rejected"))


def webhook_bodies(spark: SparkSession, data: str) -> DataFrame:
    runs = table(spark, data, "ci_runs")
    body = F.to_json(
        F.struct(
            "action",
            F.struct(F.col("repository").alias("full_name")).alias("repository"),
            F.struct(F.col("author_name").alias("login")).alias("sender"),
            F.when(F.col("conclusion") != "failure", F.struct(F.col("workflow_id").alias("id"))).alias("installation"),
        )
    )
    broken = F.col("head_sha").isNull()
    return runs.select(
        F.col("run_id").alias("id"),
        F.lit("workflow_run").alias("event_type"),
        F.when(broken, F.lit("{not json")).otherwise(body).alias("body"),
        F.col("updated_at").alias("created_at"),
    )


@query
def append_webhook_audit(spark, data):
    return as_text(payloads.webhook_audit(webhook_bodies(spark, data)).accepted.drop("payload", "facts"))


@query
def webhook_audit_quarantine(spark, data):
    rejected = payloads.webhook_audit(webhook_bodies(spark, data)).quarantine
    return rejected.groupBy("body", "reason").agg(F.count("*").alias("rejected"))


@query
def filed_github_metrics(spark, data):
    """The four datasets of filed deliveries, whose payloads were parsed when they were filed."""
    root = run_dir(spark, "webhooks")
    named = F.concat(F.lit('"repository":{"full_name":"'), "repository_name", F.lit('",'))
    bodies = _deliveries(spark, data).withColumn("body", F.replace("payload", F.lit('"repository":{'), named))
    jobs.append_webhooks(bodies, root, "0")
    return ci.github_metrics(jobs.filed_webhooks(spark, root), ORDERS_AS_OF, LANGUAGES, "all_time")


def run_bodies(spark: SparkSession, data: str) -> DataFrame:
    """Workflow-run deliveries. The repository is named by the body or by the run, the author may be missing, and times
    come in both spellings."""
    odd = F.col("run_number") % 2 == 1
    named = F.struct(F.substring_index("repository", "/", -1).alias("name"))
    at = clock.stamp(F.col("updated_at"))
    iso = F.concat(F.translate(at, " ", "T"), F.lit("Z"))
    commit = F.struct(
        F.col("head_sha").alias("id"), F.col("head_message").alias("message"),
        F.when(F.col("run_id") % 3 != 0, F.struct(F.col("author_name").alias("name"))).alias("author"),
    )
    run = F.struct(
        F.col("run_id").alias("id"), F.col("workflow_name").alias("name"), "run_number", "conclusion", "html_url",
        F.when(odd, at).otherwise(iso).alias("updated_at"), F.when(~odd, named).alias("repository"),
        F.struct(F.concat(F.lit("login-"), F.col("author_name")).alias("login")).alias("actor"), commit.alias("head_commit"),
    )
    body = F.struct(
        "action", F.when(odd, named).alias("repository"), F.struct(F.col("workflow_id").alias("id")).alias("workflow"),
        run.alias("workflow_run"),
    )
    kind = F.when(F.col("run_id") % 50 == 0, "push").otherwise("workflow_run").alias("event_type")
    return table(spark, data, "ci_runs").select(kind, F.to_json(body).alias("body"))


@query
def extract_ci_runs(spark, data):
    return as_text(payloads.ci_runs(run_bodies(spark, data)))


@query
def append_counts_snapshot(spark, data):
    stored = table(spark, data, "stats_history")
    body = F.to_json(F.struct("books", "users", "loans", "reviews", F.col("review_images").alias("reviewImage")))
    responses = stored.select(F.col("timestamp").alias("polled_at"), body.alias("body"))
    return as_text(payloads.counts_snapshot(responses))


def gauge_polls(spark: SparkSession, data: str) -> DataFrame:
    """Five responses per poll. The counter's COUNT comes second; low cpu fails the poll, 0 connections is empty."""

    def measured(column: str) -> Column:
        return F.array(F.struct(F.lit("VALUE").alias("statistic"), F.col(column).alias("value")))

    counted = F.array(
        F.struct(F.lit("TOTAL_TIME").alias("statistic"), F.lit(-1.0).alias("value")),
        F.struct(F.lit("COUNT").alias("statistic"), F.col("http_requests").alias("value")),
    )
    responses = []
    for name, column in snapshots.GAUGES.items():
        body = F.to_json(F.struct((counted if column == "http_requests" else measured(column)).alias("measurements")))
        if column == "cpu_usage":
            body = F.when(F.col("cpu_usage") >= 0.005, body)
        if column == "active_db_connections":
            body = F.when(F.col(column) > 0, body).otherwise(F.lit("{}"))
        responses.append(F.struct(F.lit(name).alias("name"), body.alias("body")))
    gauges = table(spark, data, "app_metrics2")
    return gauges.select(F.col("timestamp").alias("polled_at"), F.inline(F.array(*responses)))


@query
def pivot_gauges(spark, data):
    return as_text(payloads.pivot_gauges(gauge_polls(spark, data)))


@query
def extract_usage(spark, data):
    usage = table(spark, data, "usage_samples")
    read = F.when(F.col("rows_read") > 1000, F.col("rows_read"))
    sums = F.struct(read.alias("rowsRead"), F.col("rows_written").alias("rowsWritten"), F.col("read_queries").alias("readQueries"))
    groups = F.array(F.struct(sums.alias("sum")))
    accounts = F.array(F.struct(groups.alias("d1AnalyticsAdaptiveGroups")))
    body = F.to_json(F.struct(F.struct(F.struct(accounts.alias("accounts")).alias("viewer")).alias("data")))
    return payloads.extract_usage(usage.select("sample_id", body.alias("body")))


@query
def extract_log_page(spark, data):
    """Pages of 50 consecutive lines; every second page states no total."""
    logs = table(spark, data, "log_events").withColumn("page", F.floor(F.col("id") / 50))
    columns = ["id", "timestamp", "environment", "platform", "level", "traceId", "tag", "message", "stackTrace"]
    total = F.when(F.col("page") % 2 == 0, F.count("*") + 1000).otherwise(0)
    pages = logs.groupBy("page").agg(
        F.to_json(F.struct(F.collect_list(F.struct(*columns)).alias("content"), total.alias("totalElements"))).alias("body")
    )
    lines = payloads.extract_log_page(pages)
    return lines.select("page", "total_logs", "id", "platform", "level", "traceId", "message")


@query
def atomic_batch_write(spark, data):
    """All five summaries published by one nightly run, read back and counted."""
    store = Store(spark, run_dir(spark, "summaries"))
    raw = {"events": _events(spark, data), "metrics": _metrics(spark, data)}
    first, last = _events(spark, data).agg(F.min("timestamp"), F.max("timestamp")).first()
    span = (clock.midnight(clock.at_ms(first)), clock.midnight(clock.at_ms(last)) + clock.DAY)
    failed = jobs.nightly(store, raw, *span)
    if failed:
        raise RuntimeError(f"rollups failed: {failed}")
    counts = [
        store.read(name).groupBy("snapshot_date").agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "snapshot_date", "row_count")
        for name, *_ in jobs.NIGHTLY
    ]
    published = counts[0]
    for count in counts[1:]:
        published = published.unionByName(count)
    return as_text(published)


# Streams: each run drains the table as a file stream, then reads what the stream maintains.

DRAIN = {"availableNow": True}


def messages(spark: SparkSession, data: str) -> DataFrame:
    """Tagged messages: the events and metrics of the tables; the tag of an error event is not known."""
    events = ingest.tagged_messages(stream(spark, data, "mobile_telemetry_events"), "EVENT")
    retagged = F.replace("value", F.lit('{"queueType":"EVENT"'), F.lit('{"queueType":"UNKNOWN"'))
    is_error = F.get_json_object("value", "$.data.eventType") == "ERROR"
    events = events.select(F.when(is_error, retagged).otherwise(F.col("value")).alias("value"))
    return events.unionByName(ingest.tagged_messages(stream(spark, data, "mobile_telemetry_api_metrics"), "METRIC"))


def _filed_counts(spark: SparkSession, root: str) -> DataFrame:
    counts = [
        ingest.read_routed(spark, root, name)
        .groupBy("event_date", "platform")
        .agg(F.count("*").alias("row_count"), F.count_distinct("id").alias("id_count"))
        .select(F.lit(name).alias("table_name"), "*")
        for name in jobs.RAW_TABLES.values()
    ]
    return as_text(counts[0].unionByName(counts[1]))


def _routed(spark: SparkSession, text: DataFrame) -> str:
    base = run_dir(spark, "route")
    ingest.route_tagged_stream(text, f"{base}/raw", f"{base}/checkpoint", DRAIN).awaitTermination()
    return f"{base}/raw"


@query
def route_tagged_stream(spark, data):
    return _filed_counts(spark, _routed(spark, messages(spark, data)))


@query
def compact_routed(spark, data):
    """The same rows after compaction of the stopped stream."""
    root = _routed(spark, messages(spark, data))
    if not ingest.compact(spark, root, through=datetime.max.date()):
        raise RuntimeError("nothing was compacted")
    return _filed_counts(spark, root)


@query
def ingest_to_raw(spark, data):
    """App payloads to the raw tables: accepted, tagged and routed by one stream."""
    events = payloads.ingest_events(event_bodies(spark, data, stream), EVENTS_AS_OF).accepted
    metrics = payloads.ingest_api_metrics(metric_bodies(spark, data, stream), EVENTS_AS_OF).accepted
    text = ingest.tagged_messages(events, "EVENT").unionByName(ingest.tagged_messages(metrics, "METRIC"))
    return _filed_counts(spark, _routed(spark, text))


def _maintained(spark: SparkSession, data: str, name: str, parts: dict) -> Store:
    base = run_dir(spark, "rollup")
    store = Store(spark, f"{base}/store")
    rollup_streams.maintain(stream(spark, data, name), parts, store, name, f"{base}/checkpoint", DRAIN).awaitTermination()
    return store


@query
def stream_api_performance(spark, data):
    parts = {"part_latency": rollup_streams.METRIC_PARTS["part_latency"]}
    return as_text(rollup_streams.api_performance(_maintained(spark, data, "mobile_telemetry_api_metrics", parts)))


@query
def stream_endpoint_latency(spark, data):
    parts = {"part_endpoints": rollup_streams.METRIC_PARTS["part_endpoints"]}
    return as_text(rollup_streams.endpoint_latency(_maintained(spark, data, "mobile_telemetry_api_metrics", parts)))


@query
def stream_funnel(spark, data):
    parts = {"part_funnel": rollup_streams.EVENT_PARTS["part_funnel"]}
    return as_text(rollup_streams.funnel(_maintained(spark, data, "mobile_telemetry_events", parts)))


@query
def stream_errors(spark, data):
    parts = {"part_errors": rollup_streams.EVENT_PARTS["part_errors"]}
    return as_text(rollup_streams.errors(_maintained(spark, data, "mobile_telemetry_events", parts)))


@query
def stream_screens(spark, data):
    parts = {"part_screens": rollup_streams.EVENT_PARTS["part_screens"]}
    return as_text(rollup_streams.screens(_maintained(spark, data, "mobile_telemetry_events", parts)))


@query
def stream_ci_incidents(spark, data):
    base = run_dir(spark, "ci")
    store = Store(spark, f"{base}/store")
    incident_streams.maintain_ci(stream(spark, data, "ci_runs"), store, f"{base}/checkpoint", DRAIN).awaitTermination()
    return as_text(store.read("ci_incidents"))


@query
def stream_probe_incidents(spark, data):
    base = run_dir(spark, "probes")
    store = Store(spark, f"{base}/store")
    incident_streams.maintain_probes(
        stream(spark, data, "health_probes"), store, f"{base}/checkpoint", DRAIN
    ).awaitTermination()
    return as_text(store.read("probe_incidents").select(*incidents.INCIDENT))


@query
def stream_quota_levels(spark, data):
    base = run_dir(spark, "quota")
    store = Store(spark, f"{base}/store")
    quota_streams.maintain_quota(stream(spark, data, "usage_samples"), store, f"{base}/checkpoint", DRAIN).awaitTermination()
    return quota_streams.levels(store).select("sample_id", "resource", "rows_read_24h", "level")
