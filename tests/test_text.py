from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconlake.functions import text


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")
    return [r[0] for r in rows.orderBy("n").select(function(F.col("v"))).collect()]


def test_endpoints(spark):
    given = {
        " /users/9/books/10 ": "/users/:id/books/:id",
        "/2fa/login": "/:idfa/login",
        "/img/a-b.PNG": "/img/:filename",
        "/img/42.webp": "/img/:filename",
        "/a.png/b": "/a.png/b",
        "\t/x/1\n": "/x/:id",
        " /x﻿": "/x",
        "": "",
    }
    assert apply(spark, text.normalize_endpoint, list(given)) == list(given.values())


def test_keyword_cleanup_drops_noise(spark):
    given = [' "dune" ', "978", "ALL_BOOKS", "''", None, "it's", "９"]
    assert apply(spark, text.clean_keyword, given) == ["dune", None, None, None, None, "its", "９"]


def test_display_keyword_keeps_letters(spark):
    assert apply(spark, text.display_keyword, ["“region one”", None, " 'a b' "]) == ["regionone", "N/A", "ab"]


def test_humanize(spark):
    given = [0, 999, 1000, 104600, 999999, 1000000, 4256000]
    assert apply(spark, text.humanize_count, given, "bigint") == [
        "0", "999", "1.0K", "104.6K", "1000.0K", "1.00M", "4.26M"
    ]


@pytest.mark.parametrize(
    "minutes, label", [(0, "Just now"), (1, "1m ago"), (59, "59m ago"), (60, "1h ago"), (1439, "23h ago"), (1440, "1d ago")]
)
def test_relative_time(spark, minutes, label):
    now = datetime(2024, 1, 31)
    row = spark.createDataFrame([(now - timedelta(minutes=minutes),)], "t timestamp")
    assert row.select(text.relative_time(F.col("t"), now)).first()[0] == label


def test_log_relative_time(spark):
    now = datetime(2024, 1, 31)
    rows = spark.createDataFrame([(now - timedelta(minutes=2),), (now - timedelta(minutes=3),), (None,)], "t timestamp")
    labels = [r[0] for r in rows.select(text.log_relative_time(F.col("t"), now)).collect()]
    assert labels == ["Just Now", "3m ago", "Live"]


def test_durations(spark):
    assert apply(spark, text.duration_label, [60, 61, 9, None], "bigint") == ["60m", "1h 1m", "9m", "0 m"]


def test_uptime(spark):
    assert apply(spark, text.uptime_label, [0.0, 3599.0, 7200.0, 90000.5], "double") == ["0h", "0h", "2h", "1d 1h"]


def test_null_counters_have_no_label(spark):
    row = spark.range(1).select(text.fixed(F.lit(None), 1).alias("a"), text.humanize_count(F.lit(None).cast("bigint")).alias("b")).first()
    assert row.a is None and row.b is None
