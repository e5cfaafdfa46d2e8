"""Daily rollups of raw telemetry. ``since``/``until`` bound a run; omit both to roll up every day present.

Every aggregate combines on the map side, so a day or platform that owns most of the rows does not own a task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.functions.clock import event_date, within
from beaconlake.functions.text import normalize_endpoint

# Event names that make up the funnel.
SCAN_SCREEN = "SCANNER_SCREEN"
CART_SCREEN = "CART_SCREEN"
ADD_TO_CART = "BOOK_ADD_CART"
RENT = "BOOK_RENT_ACTION"
SEARCH = "BOOK_SEARCH"
LOAD_FAILURES = ("HOME_DATA_LOAD_FAILURE", "BOOK_DETAIL_LOAD_FAILURE")
BARCODE = "BARCODE_SCANNER"

KEYWORDS_TYPE = "array<struct<keyword: string, count: bigint>>"


def with_day(df: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """Raw rows of a run window with their UTC day as ``snapshot_date``."""
    return within(df, since, until).withColumn("snapshot_date", event_date(F.col("timestamp")))


def latency_histogram(daily_metrics: DataFrame) -> DataFrame:
    """Requests and errors per (day, platform, latency). Any status other than 200 is an error, 201 and 304 too."""
    return daily_metrics.groupBy("snapshot_date", F.col("platform").alias("os_platform"), "latency_ms").agg(
        F.count("*").alias("requests"),
        F.count_if(F.col("status_code") != 200).alias("errors"),
    )


def performance_from_histogram(histogram: DataFrame) -> DataFrame:
    """Nearest-rank percentiles read off the running request count of each (day, platform).

    The window sees one row per distinct integer latency, never the requests themselves. Requests without a latency
    count as requests but have no rank.
    """
    day = Window.partitionBy("snapshot_date", "os_platform")
    ranked = F.when(F.col("latency_ms").isNotNull(), F.col("requests")).otherwise(0)
    placed = histogram.withColumn("ranked", ranked).select(
        "*",
        F.sum("ranked").over(day.orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("ranked").over(day).alias("all"),
    )

    def rank(percent: int) -> Column:
        reached = F.col("upto") * 100 >= F.col("all") * percent
        return F.min(F.when(reached, F.col("latency_ms"))).cast("bigint").alias(f"p{percent}_ms")

    return placed.groupBy("snapshot_date", "os_platform").agg(
        rank(50),
        rank(95),
        rank(99),
        F.sum("requests").alias("total_requests"),
        F.sum("errors").alias("error_requests"),
    )


def daily_api_performance(
    metrics: DataFrame, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    return performance_from_histogram(latency_histogram(with_day(metrics, since, until)))


def endpoint_sums(daily_metrics: DataFrame) -> DataFrame:
    """Latency sum and call count per (day, normalised endpoint, method)."""
    return daily_metrics.groupBy("snapshot_date", normalize_endpoint(F.col("endpoint")).alias("endpoint"), "method").agg(
        F.sum("latency_ms").alias("latency_sum"),
        F.count("*").alias("call_count"),
    )


def latency_from_sums(sums: DataFrame) -> DataFrame:
    """Mean over all calls: a call without a latency adds 0, as it does to the sum."""
    mean = F.round(F.coalesce(F.col("latency_sum"), F.lit(0)) / F.col("call_count"), 2)
    return sums.select("snapshot_date", "endpoint", "method", mean.alias("avg_latency_ms"), "call_count")


def daily_endpoint_latency(
    metrics: DataFrame, since: datetime | None = None, until: datetime | None = None
) -> DataFrame:
    return latency_from_sums(endpoint_sums(with_day(metrics, since, until)))


def keyword_counts(daily_events: DataFrame) -> DataFrame:
    """Searches per (day, platform, keyword); a search without text counts under the NULL keyword."""
    return (
        daily_events.where(F.col("event_name") == SEARCH)
        .groupBy(
            "snapshot_date",
            F.col("platform").alias("os_platform"),
            F.get_json_object("attributes", "$.query_text").alias("keyword"),
        )
        .agg(F.count("*").alias("count"))
    )


def keyword_items(ranked: str) -> Column:
    """Keep keyword and count of each ranked entry."""
    return F.transform(
        ranked, lambda item: F.struct(item["keyword"].alias("keyword"), item["count"].alias("count"))
    ).cast(KEYWORDS_TYPE)


def top_keywords(counts: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The n most frequent keywords per key as one ordered array.

    The rank filter lets Spark cut each map partition to n rows per key before the shuffle.
    """
    order = [F.col("count").desc(), F.col("keyword").asc()]
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    items = F.sort_array(F.collect_list(F.struct("rank", "keyword", "count")))
    return (
        ranked.where(F.col("rank") <= n)
        .groupBy(*keys)
        .agg(items.alias("items"))
        .select(*keys, keyword_items("items").alias("top_searched_keywords"))
    )


def daily_top_keywords(events: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    return top_keywords(keyword_counts(with_day(events, since, until)), ["snapshot_date", "os_platform"])


FUNNEL_COUNTS = [
    "scan_opened_count",
    "scan_success_count",
    "scan_miss_count",
    "cart_viewed_count",
    "rent_success_count",
]


def funnel_steps(daily_events: DataFrame) -> DataFrame:
    """Step counts and searches per (day, platform, searched keyword): all the funnel needs, from one scan."""
    name = F.col("event_name")
    by_barcode = F.get_json_object("attributes", "$.trigger_source") == BARCODE
    about_isbn = F.get_json_object("attributes", "$.message").ilike("%ISBN%")
    searched = F.coalesce(name == SEARCH, F.lit(False))
    return daily_events.groupBy(
        "snapshot_date",
        F.col("platform").alias("os_platform"),
        searched.alias("searched"),
        F.when(searched, F.get_json_object("attributes", "$.query_text")).alias("keyword"),
    ).agg(
        F.count_if(name == SCAN_SCREEN).alias("scan_opened_count"),
        F.count_if((name == ADD_TO_CART) & by_barcode).alias("scan_success_count"),
        F.count_if(name.isin(*LOAD_FAILURES) & about_isbn).alias("scan_miss_count"),
        F.count_if(name == CART_SCREEN).alias("cart_viewed_count"),
        F.count_if(name == RENT).alias("rent_success_count"),
        F.count("*").alias("count"),
    )


def funnel_from_steps(steps: DataFrame, n: int = 5, salts: int = 32) -> DataFrame:
    """Counts per (day, platform) with its n most frequent searches, ``[]`` when nobody searched.

    Keywords are ranked inside hash slices of each (day, platform); only the n best of a slice are collected, so a
    day with very many keywords never meets in one task and at most ``n * salts`` keywords do.
    """
    slice_of = Window.partitionBy("snapshot_date", "os_platform", "searched", "salt")
    rank = F.row_number().over(slice_of.orderBy(F.col("count").desc(), F.col("keyword").asc()))
    ranked = steps.withColumn("salt", F.pmod(F.xxhash64("keyword"), F.lit(salts))).withColumn("rank", rank)
    candidate = F.when(
        F.col("searched") & (F.col("rank") <= n), F.struct(F.negative("count").alias("order"), "keyword", "count")
    )
    best = F.slice(F.sort_array(F.collect_list(candidate)), 1, n)
    return (
        ranked.groupBy("snapshot_date", "os_platform")
        .agg(*(F.sum(name).alias(name) for name in FUNNEL_COUNTS), best.alias("best"))
        .select("snapshot_date", "os_platform", *FUNNEL_COUNTS, keyword_items("best").alias("top_searched_keywords"))
    )


def daily_funnel(events: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    return funnel_from_steps(funnel_steps(with_day(events, since, until)))


def daily_figures(metrics: DataFrame, events: DataFrame, since: datetime | None = None, until: datetime | None = None, n: int = 5, salts: int = 32) -> DataFrame:
    """Everything the daily snapshots need, from one scan of the metrics and one of the events.

    Rows of both become grains of one aggregation: requests by latency, steps by searched keyword or error name. The result
    has a row for each (day, platform), with the figures of ``daily_api_performance`` and ``daily_funnel``, and one for each
    error name as well (``error_name`` and ``occurrence_count``); funnel counts of a day are the sums over its rows.
    """
    empty = {"latency_ms": "int", "searched": "boolean", "keyword": "string", "error_name": "string"}
    counters = ["requests", "errors", *FUNNEL_COUNTS, "count"]

    def grains(rows: DataFrame, kind: str, keys: dict[str, Column], counts: dict[str, Column]) -> DataFrame:
        return rows.select(
            "snapshot_date", F.col("platform").alias("os_platform"), F.lit(kind).alias("kind"),
            *(keys.get(name, F.lit(None)).cast(type_).alias(name) for name, type_ in empty.items()),
            *(F.coalesce(counts.get(name, F.lit(0)).cast("bigint"), F.lit(0)).alias(name) for name in counters),
        )

    name, one = F.col("event_name"), F.lit(1)
    by_barcode = F.get_json_object("attributes", "$.trigger_source") == BARCODE
    about_isbn = F.get_json_object("attributes", "$.message").ilike("%ISBN%")
    searched = F.coalesce(name == SEARCH, F.lit(False))
    steps = {
        "scan_opened_count": name == SCAN_SCREEN, "scan_success_count": (name == ADD_TO_CART) & by_barcode,
        "scan_miss_count": name.isin(*LOAD_FAILURES) & about_isbn, "cart_viewed_count": name == CART_SCREEN,
        "rent_success_count": name == RENT, "count": one,
    }
    keys = {
        "searched": searched, "keyword": F.when(searched, F.get_json_object("attributes", "$.query_text")),
        "error_name": F.when(name.ilike("%_FAILURE"), name),
    }
    both = grains(with_day(metrics, since, until), "request", {"latency_ms": F.col("latency_ms")}, {"requests": one, "errors": F.col("status_code") != 200})
    both = both.unionByName(grains(with_day(events, since, until), "step", keys, steps))
    sums = both.groupBy("snapshot_date", "os_platform", "kind", *empty).agg(*(F.sum(c).alias(c) for c in counters))

    salt = F.when(F.col("searched"), F.pmod(F.xxhash64("keyword"), F.lit(salts))).otherwise(0)
    slice_of = Window.partitionBy("snapshot_date", "os_platform", "kind", "searched", "salt")
    timed = F.when(F.col("latency_ms").isNotNull(), F.col("requests")).otherwise(0)
    placed = sums.withColumn("salt", salt).withColumn("timed", timed).select(
        "*",
        F.sum("timed").over(slice_of.orderBy("latency_ms").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("timed").over(slice_of).alias("all"),
        F.row_number().over(slice_of.orderBy(F.col("count").desc(), F.col("keyword").asc())).alias("rank"),
    )

    def rank(percent: int) -> Column:
        reached = (F.col("kind") == "request") & (F.col("upto") * 100 >= F.col("all") * percent)
        return F.min(F.when(reached, F.col("latency_ms"))).cast("bigint").alias(f"p{percent}_ms")

    wanted = F.col("searched") & (F.col("rank") <= n)
    best = F.slice(F.sort_array(F.collect_list(F.when(wanted, F.struct(F.negative("count").alias("order"), "keyword", "count")))), 1, n)
    return (
        placed.groupBy("snapshot_date", "os_platform", "error_name")
        .agg(
            rank(50), rank(95), rank(99), F.sum("requests").alias("total_requests"), F.sum("errors").alias("error_requests"),
            *(F.sum(c).alias(c) for c in FUNNEL_COUNTS),
            F.sum(F.when(F.col("error_name").isNotNull(), F.col("count"))).alias("occurrence_count"), best.alias("best"),
        )
        .withColumn("top_searched_keywords", keyword_items("best"))
        .drop("best")
    )


def count_by_suffix(daily_events: DataFrame, suffix: str, name: str, count: str) -> DataFrame:
    """Events per (day, platform, name) whose name ends in ``_`` plus the suffix, in any case.

    '_' is LIKE's one-character wildcard: 'xSCREEN' matches, 'SCREEN' does not.
    """
    return (
        daily_events.where(F.col("event_name").ilike(f"%_{suffix}"))
        .groupBy("snapshot_date", F.col("platform").alias("os_platform"), F.col("event_name").alias(name))
        .agg(F.count("*").alias(count))
    )


def error_counts(daily_events: DataFrame) -> DataFrame:
    return count_by_suffix(daily_events, "FAILURE", "error_name", "occurrence_count")


def screen_counts(daily_events: DataFrame) -> DataFrame:
    return count_by_suffix(daily_events, "SCREEN", "screen_name", "visit_count")


def daily_errors(events: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    return error_counts(with_day(events, since, until))


def daily_screens(events: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    return screen_counts(with_day(events, since, until))


def day_window(raw: DataFrame, since: datetime, until: datetime) -> DataFrame:
    """Extent of a half-open run window: rows and first and last timestamp per platform."""
    return (
        within(raw, since, until)
        .groupBy("platform")
        .agg(F.count("*").alias("row_count"), F.min("timestamp").alias("first_ms"), F.max("timestamp").alias("last_ms"))
    )
