"""Raw payloads to typed rows. What cannot be accepted goes to a quarantine table with the reason."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions.clock import epoch_ms, parse_timestamp
from beaconlake.functions.payload import number_or_zero, parse_once, whole_number
from beaconlake.operators.snapshots import GAUGES


class Ingested(NamedTuple):
    accepted: DataFrame
    quarantine: DataFrame


# Both spellings arrive: camelCase from one app, snake_case from the other. Everything is read as text first,
# so a wrongly typed field rejects its own row only.
_EVENT = """
    id string, timestamp string, platform string, eventType string, event_type string,
    eventName string, event_name string, errorMessage string, error_message string,
    appVersion string, app_version string, attributes string, _malformed string"""
_METRIC = """
    id string, timestamp string, platform string, endpoint string, method string,
    statusCode string, status_code string, latencyMs string, latency_ms string, _malformed string"""


def _parse(bodies: DataFrame, schema: str) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    return parse_once(bodies, ["body"], "body", schema, options)


def _field(*names: str) -> Column:
    """First spelling that is present and not null."""
    return F.coalesce(*map(F.col, names))


def _given(value: Column) -> Column:
    """Text that JavaScript counts as a value: neither null nor empty."""
    return F.nullif(value, F.lit(""))


def _id() -> Column:
    return F.coalesce(_given(F.col("id")), F.uuid()).alias("id")


def _timestamp(as_of: datetime) -> Column:
    return F.coalesce(F.nullif(whole_number(F.col("timestamp")), F.lit(0)), F.lit(epoch_ms(as_of))).alias("timestamp")


def _split(
    parsed: DataFrame, required: dict[str, Column], columns: list[Column], given: dict[str, Column] | None = None
) -> Ingested:
    """``given`` are the required fields before they are given their types, where that can fail."""
    missing = F.concat_ws(",", *(F.when(value.isNull(), F.lit(name)) for name, value in (given or required).items()))
    badly_typed = F.concat_ws(",", *(F.when(value.isNull(), F.lit(name)) for name, value in required.items()))
    malformed = F.col("body").isNull() | F.col("_malformed").isNotNull()
    reason = (
        F.when(malformed, "malformed_json")
        .when(missing != "", F.concat(F.lit("missing: "), missing))
        .when(badly_typed != "", F.concat(F.lit("invalid: "), badly_typed))
    )
    return Ingested(
        parsed.where(reason.isNull()).select(*columns),
        parsed.where(reason.isNotNull()).select("body", reason.alias("reason")),
    )


def ingest_events(bodies: DataFrame, as_of: datetime) -> Ingested:
    """App event payloads (column ``body``) to ``mobile_telemetry_events`` rows."""
    platform = _given(F.col("platform"))
    kind = _given(_field("eventType", "event_type"))
    name = _given(_field("eventName", "event_name"))
    attributes = F.col("attributes")
    # Only the number 0 and the boolean false are empty, not texts that look like them; few rows need the second parse.
    kind_of = F.schema_of_variant(F.try_variant_get(F.try_parse_json("body"), "$.attributes", "variant"))
    empty = F.when(attributes.isin("0", "0.0", "-0", "false"), kind_of != "STRING").otherwise(attributes == "")
    return _split(
        _parse(bodies, _EVENT),
        {"platform": platform, "event_type": kind, "event_name": name},
        [
            _id(),
            _timestamp(as_of),
            platform.alias("platform"),
            kind.alias("event_type"),
            name.alias("event_name"),
            _field("errorMessage", "error_message").alias("error_message"),
            F.coalesce(_field("appVersion", "app_version"), F.lit("1.0.0")).alias("app_version"),
            F.when(~empty, attributes).alias("attributes"),
        ],
    )


def ingest_api_metrics(bodies: DataFrame, as_of: datetime) -> Ingested:
    """API metric payloads (column ``body``) to ``mobile_telemetry_api_metrics`` rows."""
    platform, endpoint, method = (_given(F.col(name)) for name in ("platform", "endpoint", "method"))
    given = {
        "platform": platform, "endpoint": endpoint, "method": method,
        "status_code": _field("statusCode", "status_code"), "latency_ms": _field("latencyMs", "latency_ms"),
    }
    numbers = {name: given[name].try_cast("double").try_cast("int") for name in ("status_code", "latency_ms")}
    required = given | numbers
    return _split(
        _parse(bodies, _METRIC),
        required,
        [_id(), _timestamp(as_of), *(value.alias(name) for name, value in required.items())],
        given,
    )


def webhook_audit(deliveries: DataFrame) -> Ingested:
    """Webhook deliveries (id, event_type, body, created_at) to ``github_app_metrics`` rows.

    Each body is parsed once, to a variant. What the CI reads need of it is filed with the row, as ``facts``, so that they
    parse nothing.
    """
    # Inside a generator, so that no filter is pushed below the parse together with a copy of it.
    parsed = deliveries.select("*", F.inline(F.array(F.struct(F.try_parse_json("body").alias("_body")))))

    def at(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("_body", path, kind)

    def items(path: str) -> Column:
        return F.array_size(at(path, "array<variant>")).cast("bigint")

    changed = [F.coalesce(items(f"$.head_commit.{part}"), F.lit(0).cast("bigint")) for part in ("added", "removed", "modified")]
    facts = F.struct(
        at("$.ref").alias("ref"),
        items("$.commits").alias("commits"),
        (changed[0] + changed[1] + changed[2]).alias("changed_files"),
        (at("$.repository.private") == "false").alias("public"),
        at("$.repository.language").alias("language"),
        at("$.check_suite.conclusion").alias("conclusion"),
    )
    accepted = parsed.where(F.col("_body").isNotNull()).select(
        "id",
        "event_type",
        _given(at("$.action")).alias("action"),
        _given(at("$.repository.full_name")).alias("repository_name"),
        _given(at("$.sender.login")).alias("sender_login"),
        F.nullif(whole_number(at("$.installation.id")), F.lit(0)).alias("installation_id"),
        F.col("body").alias("payload"),
        "created_at",
        facts.alias("facts"),
    )
    rejected = parsed.where(F.col("_body").isNull()).select("body", F.lit("malformed_json").alias("reason"))
    return Ingested(accepted, rejected)


_RUN = """
    action string, repository struct<name: string>, workflow struct<id: bigint>,
    workflow_run struct<
        id: bigint, name: string, run_number: bigint, conclusion: string, html_url: string, updated_at: string,
        repository: struct<name: string>, actor: struct<login: string>,
        head_commit: struct<id: string, message: string, author: struct<name: string>>
    >
"""


def ci_runs(deliveries: DataFrame) -> DataFrame:
    """Webhook deliveries (event_type, body) to ``ci_runs`` rows, one for each workflow run they report.

    Other events and bodies without a run or a workflow give no row. A run's author is its head commit's, or else whoever
    started it.
    """
    reported = deliveries.where(F.col("event_type") == "workflow_run")
    parsed = parse_once(reported, [], "body", _RUN).where(F.col("workflow_run").isNotNull() & F.col("workflow").isNotNull())
    run = F.col("workflow_run")
    return parsed.select(
        run["id"].alias("run_id"),
        "action",
        F.coalesce(_given(F.col("repository.name")), run["repository"]["name"]).alias("repository"),
        F.col("workflow.id").alias("workflow_id"),
        run["name"].alias("workflow_name"),
        run["run_number"].alias("run_number"),
        run["conclusion"].alias("conclusion"),
        run["head_commit"]["id"].alias("head_sha"),
        run["head_commit"]["message"].alias("head_message"),
        F.coalesce(_given(run["head_commit"]["author"]["name"]), run["actor"]["login"]).alias("author_name"),
        run["html_url"].alias("html_url"),
        parse_timestamp(run["updated_at"]).alias("updated_at"),
    )


def counts_snapshot(responses: DataFrame) -> DataFrame:
    """Cumulative-count responses (polled_at, body) to ``stats_history`` rows."""
    schema = "books bigint, users bigint, loans bigint, reviews bigint, reviewImage bigint"
    return responses.select("polled_at", F.from_json("body", schema).alias("p")).select(
        "p.books", "p.users", "p.loans", "p.reviews",
        F.col("p.reviewImage").alias("review_images"),
        F.col("polled_at").alias("timestamp"),
    )


_GAUGE = "measurements array<struct<statistic: string, value: double>>"
_COUNTED = "spring.security.http.secured.requests"


def pivot_gauges(polls: DataFrame) -> DataFrame:
    """Gauge responses (polled_at, name, body) to one wide ``app_metrics2`` row per poll.

    The request counter takes its COUNT measurement, other gauges their first one. A response without that
    measurement reads 0; a failed poll (NULL body) stays NULL.
    """
    taken = F.from_json("body", _GAUGE)["measurements"]
    counts = F.filter(taken, lambda m: m["statistic"] == "COUNT")
    chosen = F.get(F.when(F.col("name") == _COUNTED, counts).otherwise(taken), F.lit(0))["value"]
    values = polls.select(
        F.col("polled_at").alias("timestamp"),
        "name",
        F.when(F.col("body").isNotNull(), F.coalesce(chosen, F.lit(0.0))).alias("value"),
    )
    wide = (F.max(F.when(F.col("name") == name, F.col("value"))).alias(column) for name, column in GAUGES.items())
    return values.groupBy("timestamp").agg(*wide)


_USAGE = "$.data.viewer.accounts[0].d1AnalyticsAdaptiveGroups[0].sum"


def extract_usage(responses: DataFrame) -> DataFrame:
    """Usage responses (column ``body``): the three counters, 0 where the path is missing."""
    return responses.select(
        *(name for name in responses.columns if name != "body"),
        number_or_zero(F.col("body"), f"{_USAGE}.rowsRead").alias("rows_read"),
        number_or_zero(F.col("body"), f"{_USAGE}.rowsWritten").alias("rows_written"),
        number_or_zero(F.col("body"), f"{_USAGE}.readQueries").alias("read_queries"),
    )


_LOG_PAGE = """
    content array<struct<id: bigint, timestamp: timestamp, environment: string, platform: string, level: string,
        traceId: string, tag: string, message: string, stackTrace: string>>,
    totalElements bigint"""


def extract_log_page(pages: DataFrame) -> DataFrame:
    """Log page envelopes (column ``body``) to one row per line; an empty page keeps one row without a line.

    ``total_logs`` is the page's own total, or its number of lines where that is 0 or missing.
    """
    kept = [name for name in pages.columns if name != "body"]
    parsed = pages.select(*kept, F.from_json("body", _LOG_PAGE).alias("p"))
    lines = F.coalesce(F.array_size("p.content"), F.lit(0)).cast("bigint")
    total = F.coalesce(F.nullif(F.col("p.totalElements"), F.lit(0)), lines)
    return parsed.select(*kept, total.alias("total_logs"), F.inline_outer("p.content"))
