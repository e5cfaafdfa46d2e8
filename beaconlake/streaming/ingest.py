"""Tagged message stream to the raw tables.

Accepted payloads become tagged messages; the router files the messages of a micro-batch under all raw tables in one commit
of Spark's file sink; finished arrival dates are compacted into the raw tables' own folders.

    <root>/landing/table_name=/arrived_on=/event_date=   written by the stream; its commit log decides what readers see
    <root>/<table>/event_date=/batch_id=arrived-<date>   compacted
    <root>/filed_to                                      last arrival date that is read from the compacted folders
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconlake.functions.clock import event_date, utc_day
from beaconlake.plans.publish import delete_folder, folder_names
from beaconlake.schemas import TABLES

_MESSAGE = """
    queueType string,
    data struct<id: string, timestamp: bigint, platform: string, eventType: string, eventName: string,
        errorMessage: string, appVersion: string, attributes: string, endpoint: string, method: string,
        statusCode: int, latencyMs: int>"""

# Raw table and column mapping of each tag. Messages with another tag are dropped.
_ROUTES = {
    "EVENT": (
        "mobile_telemetry_events",
        {
            "id": "id", "timestamp": "timestamp", "platform": "platform", "event_type": "eventType",
            "event_name": "eventName", "error_message": "errorMessage", "app_version": "appVersion",
            "attributes": "attributes",
        },
    ),
    "METRIC": (
        "mobile_telemetry_api_metrics",
        {
            "id": "id", "timestamp": "timestamp", "platform": "platform", "endpoint": "endpoint",
            "method": "method", "status_code": "statusCode", "latency_ms": "latencyMs",
        },
    ),
}


QUARANTINE = "quarantined_messages"
QUARANTINED = "value string, reason string"

_COLUMNS = {table: TABLES[table] for table, _ in _ROUTES.values()} | {QUARANTINE: QUARANTINED}
_PARTS = "table_name string, arrived_on date, event_date date"


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(",")]


def _landed_schema() -> str:
    """Columns of all tables, each once, and the folders."""
    fields: dict[str, str] = {}
    for ddl in _COLUMNS.values():
        fields |= {field.split()[0]: field.strip() for field in ddl.split(",")}
    return ", ".join([*fields.values(), _PARTS])


def tagged_messages(rows: DataFrame, tag: str) -> DataFrame:
    """Rows of the raw table that a tag names, as message text (column ``value``); columns that are null are left out."""
    _, columns = _ROUTES[tag]
    data = F.struct(*(F.col(name).alias(source) for name, source in columns.items()))
    return rows.select(F.to_json(F.struct(F.lit(tag).alias("queueType"), data.alias("data"))).alias("value"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message text (column ``value``) to tag, data, and the ``reason`` for which it cannot be stored, if any.

    Messages with another tag are no fault and have neither.
    """
    parsed = messages.select("value", F.from_json("value", _MESSAGE).alias("m")).select("value", "m.queueType", "m.data")
    known = F.col("queueType").isin(*_ROUTES)
    reason = (
        F.when(F.col("queueType").isNull(), "unreadable")
        .when(known & F.col("data.id").isNull(), "no id")
        .when(known & F.col("data.timestamp").isNull(), "no timestamp")
    )
    return parsed.withColumn("reason", reason)


def route_tagged_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    redelivery: str = "1 day",
    writers: int = 4,
    horizon: timedelta | None = None,
    log_retention: str | None = None,
) -> StreamingQuery:
    """File each message under the raw table its tag names, once per id.

    All tables of a micro-batch are one write of the file sink, whose log lists a batch's files in one step: a reader sees
    the whole batch or nothing of it, whenever the stream stops, and a replayed batch is committed once. Redelivered ids are
    dropped within ``redelivery`` of the first arrival; the watermark runs on arrival time, so no row is ever too late,
    however old its own timestamp. A table's date is spread over ``writers`` files a batch. A landing folder and its
    checkpoint belong together; to start anew, take a new root.

    Messages that cannot be read, or lack an id or a time, are filed as ``quarantined_messages`` with a reason; so are those
    whose time lies further than ``horizon`` from their arrival, which bounds the folders that wrong clocks can open.

    The ids of the redelivery span are the stream's state; choose a disk-backed state store for large ones
    (``spark.sql.streaming.stateStore.providerClass``). ``log_retention`` lets the sink's log forget files older than that;
    choose it longer than compaction may lag behind.
    """
    spark = messages.sparkSession
    until = filed_to(spark, root)
    if until is not None and until >= spark.range(1).select(utc_day(F.current_timestamp())).first()[0]:
        raise ValueError(f"arrival dates up to {until} are compacted: rows that arrive on them now would not be read")
    if folder_names(spark, f"{root}/landing/_spark_metadata") and not folder_names(spark, checkpoint):
        raise ValueError(f"{root}/landing belongs to another checkpoint: the sink would take new batches for committed ones")
    tagged = parse_messages(messages).where(F.col("queueType").isin(*_ROUTES) | F.col("reason").isNotNull())
    tagged = tagged.withColumn("arrived_at", F.current_timestamp())
    if horizon is not None:
        distance = F.abs(F.col("data.timestamp") - F.unix_millis("arrived_at"))
        tagged = tagged.withColumn(
            "reason", F.when(F.col("reason").isNull() & (distance > horizon // timedelta(milliseconds=1)), "implausible timestamp").otherwise(F.col("reason"))
        )
    own = F.when(F.col("reason").isNull(), F.col("data.id")).otherwise(F.sha2("value", 256))
    once = tagged.withColumn("key", own).withWatermark("arrived_at", redelivery).dropDuplicatesWithinWatermark(["queueType", "reason", "key"])

    table = F.lit(QUARANTINE)
    for tag, (name, _) in _ROUTES.items():
        table = F.when(F.col("reason").isNull() & (F.col("queueType") == tag), name).otherwise(table)
    sources = {name: source for _, columns in _ROUTES.values() for name, source in columns.items()}
    faulty = F.col("reason").isNotNull()
    columns = [F.when(~faulty, F.col(f"data.{source}")).alias(name) for name, source in sources.items()]
    filed = once.select(
        *columns, F.when(faulty, F.col("value")).alias("value"), "reason", table.alias("table_name"),
        utc_day(F.col("arrived_at")).alias("arrived_on"), F.when(~faulty, event_date(F.col("data.timestamp"))).alias("event_date"),
        F.pmod(F.xxhash64("key"), F.lit(writers)).alias("writer"),
    )
    # Five seconds is the batch timeout of the queue this replaces.
    sink = filed.repartition("table_name", "event_date", "writer").drop("writer").writeStream.format("parquet")
    if log_retention is not None:
        sink = sink.option("retention", log_retention)
    return (
        sink.partitionBy(*_names(_PARTS))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start(f"{root}/landing")
    )


def _landed(spark: SparkSession, root: str, filed_to: date | None) -> DataFrame | None:
    """Committed rows of the stream that arrived after ``filed_to``; None before the first commit."""
    if "_spark_metadata" not in folder_names(spark, f"{root}/landing"):
        return None
    rows = spark.read.schema(_landed_schema()).parquet(f"{root}/landing")
    return rows if filed_to is None else rows.where(F.col("arrived_on") > F.lit(filed_to))


def filed_to(spark: SparkSession, root: str) -> date | None:
    """The last arrival date that was compacted."""
    if not folder_names(spark, f"{root}/filed_to"):
        return None
    return spark.read.schema("filed_to date").parquet(f"{root}/filed_to").agg(F.max("filed_to")).first()[0]


def _batch(day: date) -> str:
    return f"arrived-{day:%Y-%m-%d}"


def read_routed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a raw table with their ``event_date``: what was filed below ``<root>/<table>``, and what the stream has
    committed since. Folders of a compaction that has not ended are left out."""
    until = filed_to(spark, root)
    names, parts = _names(_COLUMNS[table]), []
    if folder_names(spark, f"{root}/{table}"):
        stored = spark.read.schema(f"{_COLUMNS[table]}, event_date date, batch_id string").parquet(f"{root}/{table}")
        complete = ~F.col("batch_id").startswith("arrived-")
        if until is not None:
            complete = complete | (F.col("batch_id") <= _batch(until))
        parts.append(stored.where(complete).select(*names, "event_date"))
    landed = _landed(spark, root, until)
    if landed is not None:
        parts.append(landed.where(F.col("table_name") == table).select(*names, "event_date"))
    if not parts:
        return spark.createDataFrame([], f"{_COLUMNS[table]}, event_date date")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact(spark: SparkSession, root: str, through: date | None = None, rows_per_file: int = 5_000_000) -> list[date]:
    """Rewrite finished arrival dates of the stream as few files for each event date; returns the dates.

    A date is finished once the stream has committed a later one, since batches are committed in the order of their time;
    ``through`` finishes dates of a stream that has stopped, which then cannot start again before the next date. Readers change over when the date is entered in ``filed_to``,
    for all tables at once; a run that stops before that is repeated over the same rows. Only one compaction may run.
    """
    landed = _landed(spark, root, filed_to(spark, root))
    if landed is None:
        return []
    # arrival dates are the router's own, so there are as many as days since the last compaction
    found = sorted(row[0] for row in landed.select("arrived_on").distinct().collect())
    finished = [day for day in found if day < found[-1] or (through is not None and day <= through)]
    for day in finished:
        for table, ddl in _COLUMNS.items():
            rows = landed.where((F.col("table_name") == table) & (F.col("arrived_on") == F.lit(day)))
            (
                rows.select(*_names(ddl), "event_date", F.lit(_batch(day)).alias("batch_id"))
                .hint("rebalance", "event_date")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("maxRecordsPerFile", rows_per_file)
                .partitionBy("event_date", "batch_id")
                .parquet(f"{root}/{table}")
            )
        spark.createDataFrame([(day,)], "filed_to date").coalesce(1).write.mode("append").parquet(f"{root}/filed_to")
    return finished


def drop_landed(spark: SparkSession, root: str, before: date) -> list[str]:
    """Delete landed files of compacted dates before a date, which lies further back than any read that still runs."""
    until, dropped = filed_to(spark, root), []
    for table in folder_names(spark, f"{root}/landing"):
        for name in folder_names(spark, f"{root}/landing/{table}") if table.startswith("table_name=") else []:
            day = date.fromisoformat(name.removeprefix("arrived_on="))
            if until is not None and day <= until and day < before:
                delete_folder(spark, f"{root}/landing/{table}/{name}")
                dropped.append(f"{table}/{name}")
    return sorted(dropped)
