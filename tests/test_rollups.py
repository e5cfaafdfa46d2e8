import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beaconlake.functions.clock import epoch_ms
from beaconlake.operators import reads, rollups, snapshots

METRIC = "id string, timestamp bigint, platform string, endpoint string, method string, status_code int, latency_ms int"
EVENT = (
    "id string, timestamp bigint, platform string, event_type string, event_name string, error_message string,"
    " app_version string, attributes string"
)
DAY = datetime(2024, 1, 10)
NOON = epoch_ms(DAY) + 12 * 3600000


def metrics(spark, rows):
    return spark.createDataFrame([(str(n), NOON, "iOS", "/x", "GET", s, l) for n, (s, l) in enumerate(rows)], METRIC)


def events(spark, rows):
    return spark.createDataFrame(
        [(str(n), NOON, p, "CUSTOM_EVENT", name, None, "1", attributes) for n, (p, name, attributes) in enumerate(rows)],
        EVENT,
    )


@pytest.mark.parametrize("n", [1, 2, 19, 20, 99, 100, 101])
def test_percentiles_are_nearest_rank(spark, n):
    values = [random.Random(n).randrange(1, 50) for _ in range(n)]
    row = rollups.daily_api_performance(metrics(spark, [(200, v) for v in values])).first()
    ordered = sorted(values)
    expected = [ordered[max(0, math.ceil(p * n / 100) - 1)] for p in (50, 95, 99)]
    assert [row.p50_ms, row.p95_ms, row.p99_ms] == expected


def test_requests_without_latency_count_but_have_no_rank(spark):
    row = rollups.daily_api_performance(metrics(spark, [(200, None), (201, None), (304, 5)])).first()
    assert (row.p50_ms, row.p99_ms, row.total_requests, row.error_requests) == (5, 5, 3, 2)


def test_no_latency_at_all(spark):
    row = rollups.daily_api_performance(metrics(spark, [(200, None)])).first()
    assert (row.p50_ms, row.total_requests) == (None, 1)


def test_empty_day(spark):
    found = rollups.daily_api_performance(metrics(spark, [(200, 1)]), datetime(2024, 2, 1), datetime(2024, 2, 2))
    assert found.count() == 0


def test_suffix_needs_a_character_and_ignores_case(spark):
    names = ["FAILURE", "xFAILURE", "net_failure", "FAILURES"]
    found = rollups.daily_errors(events(spark, [("iOS", n, None) for n in names]))
    assert sorted(r.error_name for r in found.collect()) == ["net_failure", "xFAILURE"]


def test_funnel_keywords_order_ties_nulls_and_empty(spark):
    def search(word):
        return '{"query_text": "%s"}' % word

    rows = [("iOS", "BOOK_SEARCH", search(w)) for w in "aabbccddeeff"]
    rows += [("iOS", "BOOK_SEARCH", "{}")] * 3 + [("Android", "CART_SCREEN", None)]
    found = {r.os_platform: r for r in rollups.daily_funnel(events(spark, rows)).collect()}
    assert [(k.keyword, k["count"]) for k in found["iOS"].top_searched_keywords] == [
        (None, 3), ("a", 2), ("b", 2), ("c", 2), ("d", 2)
    ]
    assert found["Android"].top_searched_keywords == [] and found["Android"].cart_viewed_count == 1


def test_funnel_agrees_with_separate_top_keywords(spark, data):
    from beaconlake.sources.derived import table

    raw = table(spark, data, "mobile_telemetry_events")
    one = rollups.daily_funnel(raw).where(F.size("top_searched_keywords") > 0)
    two = rollups.daily_top_keywords(raw)
    keys = ["snapshot_date", "os_platform", "top_searched_keywords"]
    assert sorted(map(str, one.select(*keys).collect())) == sorted(map(str, two.select(*keys).collect()))


def test_funnel_ignores_broken_attributes(spark):
    rows = [("iOS", "BOOK_ADD_CART", "{broken"), ("iOS", "BOOK_ADD_CART", '{"trigger_source": "BARCODE_SCANNER"}')]
    assert rollups.daily_funnel(events(spark, rows)).first().scan_success_count == 1


def test_rollup_of_two_days_is_the_union_of_rollups(spark, data):
    from beaconlake.sources.derived import table

    raw = table(spark, data, "mobile_telemetry_api_metrics")
    a, b, c = datetime(2024, 1, 5), datetime(2024, 1, 6), datetime(2024, 1, 7)
    for build in (rollups.daily_api_performance, rollups.daily_endpoint_latency):
        both = build(raw, a, c).collect()
        apart = build(raw, a, b).collect() + build(raw, b, c).collect()
        assert sorted(map(str, both)) == sorted(map(str, apart)) and both


def test_percentiles_are_ordered(spark, data):
    from beaconlake.sources.derived import table

    found = rollups.daily_api_performance(table(spark, data, "mobile_telemetry_api_metrics"))
    assert found.where("p50_ms > p95_ms or p95_ms > p99_ms").count() == 0


def test_zero_requests_have_no_error_rate(spark):
    summary = spark.createDataFrame(
        [(DAY.date(), "iOS", 1, 1, 1, 0, 0)],
        "snapshot_date date, os_platform string, p50_ms bigint, p95_ms bigint, p99_ms bigint,"
        " total_requests bigint, error_requests bigint",
    )
    assert reads.performance_series(summary, DAY).first().error_rate is None
    assert snapshots.platform_perf_7d(summary, DAY).first().error_rate == 0.0


def test_slow_endpoints_average_days_not_calls(spark):
    summary = spark.createDataFrame(
        [(DAY.date(), "/a", "GET", 10.0, 1000), (datetime(2024, 1, 9).date(), "/a", "GET", 20.0, 1)],
        "snapshot_date date, endpoint string, method string, avg_latency_ms double, call_count bigint",
    )
    row = reads.slow_endpoints(summary, DAY).first()
    assert (row.latency_ms, row.total_calls) == (15.0, 1001)
