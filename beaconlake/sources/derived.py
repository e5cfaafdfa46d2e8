"""Telemetry tables derived from the generic ``events`` and ``orders`` tables.

Each mapping is one projection. The expressions are shared by Spark and DuckDB; only the tokens in braces differ,
so the oracle reads exactly the rows the Spark query reads.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from beaconlake.functions.clock import utc

TIME_COLUMN = {"events": "ts", "orders": "o_orderdate"}

# The files hold wall clock times in UTC; this makes them instants, whatever the session time zone.
_SECONDS = "cast(cast({} - timestamp_ntz'1970-01-01 00:00:00' as interval second) as decimal(20, 6))"
_INSTANT = f"timestamp_micros(cast({_SECONDS} * 1000000 as bigint))"
_SPARK = {
    "{STR}": "string",
    "{TS:ts}": _INSTANT.format("ts"),
    "{SEC:ts}": f"date_trunc('second', {_INSTANT.format('ts')})",
    "{TS:o_orderdate}": _INSTANT.format("o_orderdate"),
    "{TS:opened}": _INSTANT.format("opened"),
    "{TS:closed}": _INSTANT.format("closed"),
    "{MS}": f"unix_millis({_INSTANT.format('ts')})",
    "{K}": "get_json_object(props, '$.k')",
}
_DUCKDB = {
    "{STR}": "varchar",
    "{TS:ts}": "ts",
    "{SEC:ts}": "date_trunc('second', ts)",
    "{TS:o_orderdate}": "o_orderdate",
    "{TS:opened}": "opened",
    "{TS:closed}": "closed",
    "{MS}": "epoch_us(ts) // 1000",
    "{K}": "json_extract_string(props, '$.k')",
}


@dataclass(frozen=True)
class Mapping:
    base: str
    columns: dict[str, str]
    helpers: dict[str, str] = field(default_factory=dict)


# Helper columns are computed once per row and used by several output columns.
_K = {"k": "cast({K} as int)"}
_OPENED = {
    "opened": "o_orderdate + (o_orderkey % 1440) * interval '1' minute",
    "closed": (
        "o_orderdate + (o_orderkey % 1440) * interval '1' minute + (o_custkey % 180) * interval '1' minute"
        " + (o_orderkey % 60) * interval '1' second"
    ),
}
_PLATFORM = "case when user_id % 2 = 0 then 'Android' else 'iOS' end"
_REPOSITORY = (
    "case o_custkey % 6 when 0 then 'acme/mobile' when 1 then 'acme/tablet' when 2 then 'acme/api'"
    " when 3 then 'acme/reports' when 4 then 'acme/docs' else 'acme/misc' end"
)

MAPPINGS: dict[str, Mapping] = {
    "mobile_telemetry_api_metrics": Mapping(
        "events",
        {
            "id": "cast(event_id as {STR})",
            "timestamp": "{MS}",
            "platform": _PLATFORM,
            "endpoint": (
                "case event_type when 'view' then concat('/api/v1/books/', event_id)"
                " when 'click' then concat(' /uploads/cover-', event_id, '.WEBP ')"
                " when 'purchase' then concat('/api/v1/users/', user_id, '/loans')"
                " when 'signup' then '/api/v1/auth/register' else '/api/v1/books/search' end"
            ),
            "method": "case when event_type in ('purchase', 'signup') then 'POST' else 'GET' end",
            "status_code": "case event_type when 'error' then 500 when 'signup' then 201 else 200 end",
            "latency_ms": "cast(floor(value) as int)",
        },
    ),
    "mobile_telemetry_events": Mapping(
        "events",
        {
            "id": "cast(event_id as {STR})",
            "timestamp": "{MS}",
            "platform": _PLATFORM,
            "event_type": (
                "case event_type when 'view' then 'SCREEN_VIEW' when 'error' then 'ERROR' else 'CUSTOM_EVENT' end"
            ),
            "event_name": (
                "case event_type"
                " when 'view' then (case k % 3 when 0 then 'HOME_SCREEN' when 1 then 'SCANNER_SCREEN'"
                " else 'CART_SCREEN' end)"
                " when 'click' then (case k % 2 when 0 then 'BOOK_SEARCH' else 'BOOK_ADD_CART' end)"
                " when 'purchase' then 'BOOK_RENT_ACTION'"
                " when 'error' then (case k % 3 when 0 then 'HOME_DATA_LOAD_FAILURE'"
                " when 1 then 'BOOK_DETAIL_LOAD_FAILURE' else 'login_failure' end)"
                " else 'USER_SIGNUP' end"
            ),
            "error_message": "case when event_type = 'error' then concat('E', k % 5) end",
            "app_version": "concat('1.', k % 3, '.0')",
            "attributes": (
                "case when event_type = 'click' and k % 2 = 0 then concat('{\"query_text\": \"',"
                " case when k % 10 = 0 then 'ALL_BOOKS' when k % 10 = 2 then '978' else concat('kw', k % 12) end,"
                " '\"}')"
                " when event_type = 'click' then (case when k % 3 = 0 then '{\"trigger_source\": \"BARCODE_SCANNER\"}'"
                " else '{\"trigger_source\": \"LIST\"}' end)"
                " when event_type = 'error' then (case when k % 4 = 0 then '{\"message\": \"isbn not found\"}'"
                " else '{\"message\": \"timeout\"}' end) end"
            ),
        },
        _K,
    ),
    "stats_history": Mapping(
        "events",
        {
            "timestamp": "{SEC:ts}",
            "books": "1000 + cast(floor(event_id / 10) as bigint)",
            "users": "cast(floor(event_id / 7) as bigint)",
            "loans": "cast(floor(event_id / 5) as bigint)",
            "reviews": "cast(floor(event_id / 4) as bigint)",
            "review_images": "cast(floor(event_id / 9) as bigint)",
        },
    ),
    "app_metrics2": Mapping(
        "events",
        {
            "timestamp": "{SEC:ts}",
            "cpu_usage": "value / 1000",
            "jvm_memory_used": "value * 3145728",
            "http_requests": "cast(event_id * 3 as double)",
            "active_db_connections": "cast(user_id % 10 as double)",
            "uptime": "cast(event_id * 60 as double)",
        },
    ),
    "github_app_metrics": Mapping(
        "orders",
        {
            "id": "o_orderkey",
            "event_type": "case when o_orderstatus = 'P' then 'check_suite' else 'push' end",
            "action": "cast(null as {STR})",
            "repository_name": _REPOSITORY,
            "sender_login": "concat('user', o_custkey % 17)",
            "installation_id": "cast(null as bigint)",
            "payload": (
                "case when o_orderstatus = 'P' then concat('{\"check_suite\":{\"conclusion\":',"
                " case o_custkey % 3 when 0 then '\"success\"' when 1 then '\"failure\"' else 'null' end, '}}')"
                " else concat('{\"ref\":\"',"
                " case when o_orderkey % 5 = 0 then 'refs/tags/v1' else 'refs/heads/main' end,"
                " '\",\"repository\":{\"private\":', case when o_custkey % 2 = 0 then 'true' else 'false' end,"
                " ',\"language\":\"Kotlin\"},\"commits\":[',"
                " substr(repeat(',{}', cast(o_orderkey % 4 as int)), 2), '],\"head_commit\":{\"added\":[',"
                " substr(repeat(',1', cast(o_orderkey % 3 as int)), 2), '],\"removed\":[],\"modified\":[',"
                " substr(repeat(',1', cast(o_custkey % 4 as int)), 2), ']}}') end"
            ),
            "created_at": "{TS:o_orderdate}",
        },
    ),
    "incidents": Mapping(
        "orders",
        {
            "id": "concat('inc-', o_orderkey)",
            "source": "case o_custkey % 3 when 0 then 'INFRA' when 1 then 'MOBILE' else 'GITHUB' end",
            "component": (
                "case o_orderkey % 4 when 0 then 'api-probe' when 1 then 'ledger' when 2 then 'search'"
                " else 'ci' end"
            ),
            "level": (
                "case o_orderpriority when '1-URGENT' then 'FATAL' when '2-HIGH' then 'CRITICAL' else 'WARNING' end"
            ),
            "title": "concat('Incident ', o_orderkey)",
            "message": "o_orderpriority",
            "status": "case when o_orderstatus = 'O' then 'active' else 'resolved' end",
            "created_at": "{TS:opened}",
            "resolved_at": "case when o_orderstatus = 'F' then {TS:closed} end",
        },
        _OPENED,
    ),
    "log_events": Mapping(
        "events",
        {
            "id": "event_id",
            "timestamp": "{TS:ts}",
            "environment": "'prod'",
            "platform": "case user_id % 3 when 0 then 'backend' when 1 then 'android' else 'ios' end",
            "level": (
                "case when k = 0 then 'FATAL' when event_type = 'error' then 'ERROR'"
                " when event_type = 'purchase' then 'WARN' else 'INFO' end"
            ),
            "traceId": "case k % 4 when 0 then cast(null as {STR}) when 1 then '' else concat('trace', user_id) end",
            "tag": "event_type",
            "message": "repeat(concat(event_type, ' '), 1 + k % 20)",
            "stackTrace": "cast(null as {STR})",
        },
        _K,
    ),
    "health_probes": Mapping(
        "events",
        {
            "probe_id": "event_id",
            "probe_ts": "{TS:ts}",
            "component": "concat('svc-', user_id % 3)",
            "http_status": (
                "case when event_type = 'error' and value > 100 then cast(null as int)"
                " when event_type = 'error' then 503 else 200 end"
            ),
            "body_status": (
                "case when event_type = 'error' then cast(null as {STR})"
                " when event_type = 'signup' and value > 150 then 'DOWN' else 'UP' end"
            ),
            "error": "case when event_type = 'error' and value > 100 then 'timeout' end",
        },
    ),
    "ci_runs": Mapping(
        "orders",
        {
            "run_id": "o_orderkey",
            "action": "case when o_orderpriority = '5-LOW' then 'requested' else 'completed' end",
            "repository": _REPOSITORY,
            "workflow_id": "o_orderkey % 3",
            "workflow_name": "concat('build-', o_orderkey % 3)",
            "run_number": "o_orderkey",
            "conclusion": "case o_orderstatus when 'F' then 'success' when 'O' then 'failure' else 'cancelled' end",
            "head_sha": "case when o_custkey % 50 = 0 then cast(null as {STR}) else md5(cast(o_orderkey as {STR})) end",
            "head_message": "concat('commit ', o_orderkey)",
            "author_name": "concat('user', o_custkey % 17)",
            "html_url": "concat('https://ci.example/runs/', o_orderkey)",
            "updated_at": "{TS:opened}",
        },
        _OPENED,
    ),
    "usage_samples": Mapping(
        "events",
        {
            "sample_id": "event_id",
            "sample_ts": "{TS:ts}",
            "resource": "concat('db-', user_id % 2)",
            "rows_read": "cast(floor(value * 100) as bigint)",
            "rows_written": "cast(floor(value) as bigint)",
            "read_queries": "user_id",
        },
    ),
}


def _fill(text: str, tokens: dict[str, str]) -> str:
    for token, sql in tokens.items():
        text = text.replace(token, sql)
    return text


def _project(df: DataFrame, mapping: Mapping) -> DataFrame:
    helpers = [f"{_fill(sql, _SPARK)} as {alias}" for alias, sql in mapping.helpers.items()]
    if helpers:
        df = df.selectExpr("*", *helpers)
    return df.selectExpr(*(f"{_fill(sql, _SPARK)} as {column}" for column, sql in mapping.columns.items()))


def table(
    spark: SparkSession,
    data_dir: str,
    name: str,
    since: datetime | None = None,
    until: datetime | None = None,
    undated: bool = False,
) -> DataFrame:
    """A telemetry table. A range [since, until) is put on the file's own time column, where Parquet can skip by it;
    ``undated`` keeps rows without a time as well."""
    mapping = MAPPINGS[name]
    files = spark.read.parquet(f"{data_dir}/{mapping.base}.parquet")
    at = TIME_COLUMN[mapping.base]
    for bound, sign in ((since, ">="), (until, "<")):
        if bound is not None:
            kept = f"{at} {sign} timestamp_ntz'{utc(bound):%Y-%m-%d %H:%M:%S.%f}'"
            files = files.where(f"{kept} or {at} is null" if undated else kept)
    return _project(files, mapping)


def stream(spark: SparkSession, data_dir: str, name: str, **options) -> DataFrame:
    """The same table as a file stream. The file's schema is declared from its footer, not inferred from rows."""
    mapping = MAPPINGS[name]
    schema = spark.read.parquet(f"{data_dir}/{mapping.base}.parquet").schema
    files = spark.readStream.schema(schema).options(pathGlobFilter=f"{mapping.base}*.parquet", **options)
    return _project(files.parquet(data_dir), mapping)


def duckdb_select(name: str) -> str:
    mapping = MAPPINGS[name]
    base = mapping.base
    if mapping.helpers:
        helpers = ", ".join(f"{_fill(sql, _DUCKDB)} as {alias}" for alias, sql in mapping.helpers.items())
        base = f"(select *, {helpers} from {base})"
    columns = ", ".join(f'{_fill(sql, _DUCKDB)} as "{column}"' for column, sql in mapping.columns.items())
    return f"select {columns} from {base}"
