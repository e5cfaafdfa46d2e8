"""Rolling read totals and quota levels of a stream of usage samples.

The sum over the last 24 hours at a sample is: the totals of the 24 hours before its own, plus the samples of its own hour up
to it, minus those of the hour a day earlier that have left by then. So the state is kept by resource *and* hour, and a busy
resource is many small states. Each sample is sent to the hours it matters to: its own, where it enters; the next 24, as a
plain total; and the last of these also as a step, where it leaves. A state holds its hour's steps and one total.

Samples may come in any order. One that changes the sums of samples seen before has them published again with a higher
revision, and readers take the last, so any split of the same samples into batches ends in the levels of one batch run. The
state of an hour goes once the watermark, ``lateness`` behind the newest sample, has passed all that could matter to it;
Spark leaves samples later than that out and counts them in the query's progress. Samples without a time are left out too.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from beaconlake.operators.incidents import quota_level
from beaconlake.plans.publish import Store
from beaconlake.streaming import deltas

HOUR = timedelta(hours=1)
SPAN = timedelta(hours=24)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_MICRO = timedelta(microseconds=1)

EMITTED = "resource string, sample_id bigint, sample_ts timestamp, rows_read_24h bigint"
_STEP = "us bigint, sample_id bigint, delta bigint, own boolean"


def hourly_steps(samples: DataFrame) -> DataFrame:
    """What each sample means to the hours it matters to: ``resource, hour, sample_ts, us, sample_id, delta, kind``.

    Kind 0 enters, kind 1 leaves, kind 2 counts from the hour's start.
    """
    hour, span = HOUR // _MICRO, SPAN // _MICRO
    us = F.unix_micros("sample_ts")
    own = us - F.pmod(us, F.lit(hour))
    amount = F.coalesce("rows_read", F.lit(0)).cast("bigint")

    def step(hour_, us_, delta, kind):
        return F.struct(hour_.alias("hour"), us_.alias("us"), delta.alias("delta"), F.lit(kind).alias("kind"))

    # a sample at t counts up to and including t + span, hence leaves one microsecond later
    between = F.transform(F.sequence(F.lit(1), F.lit(span // hour)), lambda n: step(own + n * hour, us, amount, 2))
    steps = F.concat(F.array(step(own, us, amount, 0), step(own + span, us + span + 1, -amount, 1)), between)
    timed = samples.where(F.col("sample_ts").isNotNull())
    return timed.select("resource", "sample_id", "sample_ts", F.inline(steps))


class HourlyLevels(StatefulProcessor):
    """State of one hour of one resource: the total of the hours before it within the span, and the steps inside it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "total bigint")
        self.steps = handle.getListState("steps", _STEP)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        known = list(self.steps.get()) if self.steps.exists() else []
        before = self.total.get()[0] if self.total.exists() else 0
        if not known and not self.total.exists():
            # every sample that can matter to this hour lies before its end
            self.handle.registerTimer(int(key[1]) // 1000 + HOUR // timedelta(milliseconds=1))
        whole = new[new["kind"] == 2]["delta"]
        added = new[new["kind"] != 2]
        total = before + int(whole.sum())
        self.total.update((total,))
        fresh = [(int(u), int(i), int(d), k == 0) for u, i, d, k in zip(added["us"], added["sample_id"], added["delta"], added["kind"])]
        if fresh:
            self.steps.appendList(fresh)
        steps = [tuple(s) for s in known] + fresh
        if not steps:
            return
        us = np.array([s[0] for s in steps], np.int64)
        order = np.argsort(us, kind="stable")
        upto = np.cumsum(np.array([s[2] for s in steps], np.int64)[order])
        # equal times count together: each takes the sum behind the last of them
        rolling = total + upto[np.searchsorted(us[order], us, side="right") - 1]
        changed = us >= (us.min() if len(whole) and total != before else min((s[0] for s in fresh), default=us.max() + 1))
        out = np.flatnonzero(changed & np.array([s[3] for s in steps]))
        if len(out):
            yield pd.DataFrame({
                "resource": [key[0]] * len(out), "sample_id": [steps[i][1] for i in out],
                "sample_ts": pd.to_datetime(us[out], unit="us", utc=True), "rows_read_24h": rolling[out],
            })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.total.clear()
        self.steps.clear()
        yield from ()

    def close(self) -> None:
        pass


def maintain_quota(
    samples: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None, lateness: str = "7 days",
    table: str = "quota_levels",
) -> StreamingQuery:
    """Publish the rolling sums of each micro-batch. The state is kept in RocksDB, on the executors' disks."""
    spark = samples.sparkSession
    steps = hourly_steps(samples.withWatermark("sample_ts", lateness))
    sums = steps.groupBy("resource", "hour").transformWithStateInPandas(
        statefulProcessor=HourlyLevels(), outputStructType=EMITTED, outputMode="Update", timeMode="EventTime"
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        run = store.begin(f"{table}-stream", batch_id)
        if run.done:
            return
        revised = batch.withColumn("revision", F.lit(batch_id).cast("bigint"))
        deltas.add(run, table, revised, deltas.period(F.col("sample_ts")), _last)
        run.publish()

    provider = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # the query keeps the setting it was started with
    try:
        return (
            sums.writeStream.foreachBatch(apply)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )
    finally:
        spark.conf.set(PROVIDER, provider)


def _last(rows: DataFrame) -> DataFrame:
    """The last revision of each sample."""
    newest = F.row_number().over(Window.partitionBy("resource", "sample_id").orderBy(F.desc("revision")))
    return rows.withColumn("_rank", newest).where("_rank = 1").drop("_rank")


def levels(store: Store, table: str = "quota_levels") -> DataFrame:
    """Rows read in the trailing 24 hours at every sample, and the alarm level that reaches."""
    found = _last(deltas.read(store, table)).drop("revision")
    return found.withColumn("level", quota_level(F.col("rows_read_24h")))
