from datetime import datetime

from pyspark.sql import functions as F

from beaconlake.operators import sinks

ROW = "k string, d int, a int, b int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_keeps_absent_keys_and_is_idempotent(spark):
    old = spark.createDataFrame([("x", 1, 1, 1), ("y", 1, 2, 2), (None, 1, 3, 3)], ROW)
    new = spark.createDataFrame([("y", 1, 9, None), ("z", 1, 8, 8), (None, 1, 7, 7)], ROW)
    once = sinks.upsert_full(old, new, ["k", "d"])
    want = sorted([("x", 1, 1, 1), ("y", 1, 9, None), ("z", 1, 8, 8), (None, 1, 7, 7)], key=str)
    assert rows(once) == want
    assert rows(sinks.upsert_full(once, new, ["k", "d"])) == want


def test_partial_upsert_changes_only_the_named_columns(spark):
    old = spark.createDataFrame([("x", 1, 1, 1), ("y", 1, 2, 2)], ROW)
    new = spark.createDataFrame([("y", 1, 9, 9), ("z", 1, 8, 8)], ROW)
    once = sinks.upsert_partial(old, new, ["k", "d"], ["a"])
    want = [("x", 1, 1, 1), ("y", 1, 9, 2), ("z", 1, 8, 8)]
    assert rows(once) == want and rows(sinks.upsert_partial(once, new, ["k", "d"], ["a"])) == want


def test_unknown_condition_does_not_match(spark):
    df = spark.createDataFrame([("x", None, 1, 1), ("y", 5, 2, 2)], ROW)
    changed = sinks.conditional_update(df, F.col("d") > 1, {"a": F.lit(0)})
    assert rows(changed) == [("x", None, 1, 1), ("y", 5, 0, 2)] and changed.columns == df.columns


def test_retention_is_to_the_second(spark):
    as_of = datetime(2024, 1, 10, 0, 0, 5, 900000)
    cutoff = 1704585605000  # 2024-01-07 00:00:05
    raw = spark.createDataFrame([("a", cutoff), ("b", cutoff - 1), ("c", None)], "id string, timestamp bigint")
    assert sorted(r.id for r in sinks.retain_raw(raw, as_of).collect()) == ["a", "c"]


def test_upsert_computes_each_side_once(spark):
    old, new = spark.range(10).toDF("k"), spark.range(5, 15).toDF("k")
    plan = sinks.upsert_full(old, new, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 2 and "FullOuter" in plan


def test_a_bucketed_target_is_not_shuffled(spark, data, tmp_path):
    from test_plans import exchanges, plan

    from beaconlake.plans.registry import _incoming_incidents
    from beaconlake.sources.derived import table

    spark.sql(f"create database bucketed location '{tmp_path}'")
    try:
        stored, incoming = table(spark, data, "incidents"), _incoming_incidents(spark, data)
        sinks.store_bucketed(stored, "bucketed.incidents", ["id"], 8)
        merged = sinks.upsert_full(spark.table("bucketed.incidents"), incoming, ["id"], nullable=False)
        found = [line for line in exchanges(plan(merged)) if "BroadcastExchange" not in line]
        text = plan(merged)
        assert len(found) == 1 and "hashpartitioning(id" in found[0]
        side = text[text.index("Exchange") :]
        assert "bucketed.incidents" not in side and "Bucketed: true" in text
        sinks.upsert_bucketed("bucketed.incidents", "bucketed.incidents_2", incoming, ["id"], buckets=8)
        sinks.upsert_bucketed("bucketed.incidents_2", "bucketed.incidents_3", incoming, ["id"], ["message"], buckets=8)
        want = sinks.upsert_partial(sinks.upsert_full(stored, incoming, ["id"]), incoming, ["id"], ["message"])
        assert sorted(map(str, spark.table("bucketed.incidents_3").select(*want.columns).collect())) == sorted(map(str, want.collect()))
    finally:
        spark.sql("drop database bucketed cascade")
