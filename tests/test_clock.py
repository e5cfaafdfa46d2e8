from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from beaconlake.functions import clock


def test_yesterday_is_half_open_and_utc():
    plus9 = timezone(timedelta(hours=9))
    since, until = clock.yesterday(datetime(2024, 1, 31, 3, tzinfo=plus9))
    assert (since.isoformat(), until.isoformat()) == ("2024-01-29T00:00:00+00:00", "2024-01-30T00:00:00+00:00")


@pytest.mark.parametrize(
    "text, days", [("7", 7), ("7D", 7), ("7d", 7), ("24h", 24), ("0", 7), ("x", 7), ("", 7), (" 30d", 30)]
)
def test_range_strings(text, days):
    assert clock.parse_days(text) == days


def test_negative_range_is_refused():
    with pytest.raises(ValueError, match="negative"):
        clock.parse_days("-3")


def test_range_spans_one_more_date_than_days():
    assert clock.days_back(datetime(2024, 1, 31, 12), 7) == date(2024, 1, 24)


def test_week_labels_match_strftime(spark):
    days = [date(2019, 1, 1) + timedelta(days=n) for n in range(3300)]
    rows = (
        spark.createDataFrame([(d,) for d in days], "d date")
        .select("d", clock.week_label(F.col("d")).alias("label"))
        .collect()
    )
    assert [r.label for r in rows] == [r.d.strftime("%Y-W%W") for r in rows]


def test_both_stored_timestamp_forms_parse(spark):
    rows = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02T03:04:05.678Z",), ("soon",)], "t string")
    stamps = [r[0] for r in rows.select(clock.stamp(clock.parse_timestamp(F.col("t")))).collect()]
    assert stamps == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", None]


def test_window_prunes_partitions_and_pushes_the_range(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = spark.range(4 * 24).select(
        F.col("id").cast("string").alias("id"), (F.lit(1704067200000) + F.col("id") * 3600000).alias("timestamp")
    )
    dated = raw.withColumn("event_date", clock.event_date(F.col("timestamp")))
    dated.write.partitionBy("event_date").parquet(path)
    day = clock.within(spark.read.parquet(path), datetime(2024, 1, 2), datetime(2024, 1, 3))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 24
    assert "GreaterThanOrEqual(timestamp,1704153600000)" in plan and "LessThan(timestamp,1704240000000)" in plan
    assert "PartitionFilters: [isnotnull(event_date" in plan
