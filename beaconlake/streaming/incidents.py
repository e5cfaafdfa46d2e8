"""Incident lifecycles over streams, folded micro-batch by micro-batch.

Any split of the same rows into batches ends in the tables that one batch run over all of them gives, late rows and rows
delivered twice included. Rows are kept in hourly slices. A batch goes back to the first slice it falls into, for each
component or workflow: from there on the rows are folded anew with the batch operators, starting from the state before that
slice, and what the new fold does not confirm is withdrawn. In order, that is the hour that has begun; a late row goes back
as far as it is late.

Published tables of a stream ``t``: the incidents ``t``, its rows ``t_rows``, the notices ``t_notices``, and ``t_withdrawn``,
notices that were published and do not hold any more, for deliverers to take back. Rows and notices grow by what a batch
adds (``deltas``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from beaconlake.functions.clock import label, utc_day
from beaconlake.operators import incidents as folds
from beaconlake.plans.publish import Run, Store
from beaconlake.streaming import deltas

NULL_PART = "__HIVE_DEFAULT_PARTITION__"
#: Slice of rows without a time, which come before all others.
NEVER = "a"


def _each_batch(
    rows: DataFrame, store: Store, name: str, fold: Callable, checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    def apply(batch: DataFrame, batch_id: int) -> None:
        run = store.begin(name, batch_id)
        if run.done:
            return
        held = batch.persist()
        fold(held, run)
        run.publish()
        held.unpersist()

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def _slice(at: str) -> Column:
    """Hour of a time, as text that sorts as times do and that no reader of folders takes for a time."""
    return F.coalesce(F.concat(F.lit("h"), label(F.col(at), "yyyy-MM-ddTHH")), F.lit(NEVER))


def _before(column: str, first: str) -> Column:
    """A time that lies before a slice. A null time does."""
    return _slice(column) < F.col(first)


class Refold:
    """Rows to fold anew: those of the batch, and the stored ones of their keys from the first slice of the batch on."""

    def __init__(self, run: Run, batch: DataFrame, table: str, keys: list[str], at: str, seq: str, filed: str = deltas.DAY):
        self.keys = keys
        fresh = batch.withColumn("slice", _slice(at))
        #: One row for each key of the batch.
        self.touched = fresh.groupBy(*keys).agg(F.min("slice").alias("first")).persist()
        self.first = self.touched.agg(F.min("first")).first()[0]
        if self.first is None:
            return
        stored = deltas.read(run.store, f"{table}_rows", self.first[1 : 1 + len(filed)] or None)
        rows = fresh if stored is None else stored.select(*fresh.columns).unionByName(fresh)
        # a row that comes twice is one row
        rows = self.of_touched(rows).where(F.col("slice") >= F.col("first")).drop("slice", "first")
        self.rows = rows.dropDuplicates([*keys, at, seq]).persist()
        deltas.add(run, f"{table}_rows", fresh, deltas.period(F.col(at), filed), lambda old: old.dropDuplicates([*keys, at, seq]))

    def of_touched(self, rows: DataFrame) -> DataFrame:
        """Rows of the batch's keys, each with the ``first`` slice of its key."""
        known = self.touched.select(*(F.col(k).alias(f"_{k}") for k in self.keys), "first")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        return rows.join(known, [*same], "inner").select(*rows.columns, "first")

    def done(self) -> None:
        self.touched.unpersist()
        if self.first is not None:
            self.rows.unpersist()


def _parts_from(run: Run, table: str, column: str, first: str) -> list[str]:
    """Folders of a dated table from the date of a slice on, and that of rows without a date."""
    least = f"{column}={first[1:11]}"
    return [p for p in run.parts(table) if p >= least or p.endswith(NULL_PART) or first == NEVER]


def _replace(run: Run, table: str, parts: list[str], rows: DataFrame, column: str) -> None:
    """Replace folders of a dated table; those that get no row go."""
    run.drop(table, parts)
    run.stage(table, rows, column)


IDENTITY = ("dedup_key", "action", "at")


def stage_notices(
    run: Run, notices: DataFrame, table: str, replaced: DataFrame | None = None, identity: tuple[str, ...] = IDENTITY,
    filed: str = deltas.DAY,
) -> None:
    """Stage a run's notices, each once.

    A notice is known by its key, action and time, so a run that is repeated adds nothing; ``identity`` names more columns
    where one key may send several at a time. ``replaced`` are published notices that ``notices`` takes the place of: those
    that it does not repeat are withdrawn. Without it nothing is withdrawn, and published notices of the same dates are
    compared.
    """
    sent = deltas.period(F.col("at"), filed)
    fresh = notices.select(*folds.NOTICE).dropDuplicates([*identity]).persist()
    if replaced is None:
        # Notices of one batch fall on the few dates of its rows.
        days = {row[0] for row in fresh.select(sent).distinct().collect()}
        stored = deltas.read(run.store, table, only=days)
        if stored is not None:
            same = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in identity]
            fresh = fresh.alias("new").join(stored.alias("old"), same, "left_anti")
        deltas.add(run, table, fresh, sent)
    else:
        gone = deltas.change(run, table, fresh, replaced.select(*folds.NOTICE), [*identity], sent)
        if not gone.isEmpty():
            deltas.add(run, table.replace("_notices", "_withdrawn"), gone, sent)
        gone.unpersist()
    fresh.unpersist()


def maintain_ci(
    runs: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None, table: str = "ci_incidents"
) -> StreamingQuery:
    """One current row per workflow; the table is as small as the number of workflows and is rewritten whole.

    The transitions behind it are filed in ``<table>_changes``.
    """

    def fold(batch: DataFrame, run: Run) -> None:
        fold_runs(run, batch, table)

    return _each_batch(runs, store, f"{table}-stream", fold, checkpoint, trigger)


def fold_runs(run: Run, batch: DataFrame, table: str = "ci_incidents") -> None:
    """Stage what a batch of CI runs changes. Runs are few, so rows, transitions and notices are filed by month."""
    store, changes, filed = run.store, f"{table}_changes", deltas.MONTH
    refold = Refold(run, folds.ci_rows(batch), table, ["id"], "updated_at", "run_id", filed)
    if refold.first is None:
        return refold.done()
    current = store.read(table)
    stored = deltas.read(store, changes, refold.first[1:8] or None)
    prior, old = None, None
    if current is not None:
        # Before its first slice a workflow was failing if its first change since then says so, or, if there is none, if its
        # incident opened earlier and is still active.
        prior = refold.of_touched(current).where(_before("created_at", "first")).select("id", "status")
        if stored is not None:
            old = refold.of_touched(stored).where(~_before("updated_at", "first")).drop("first").persist()
            first = F.row_number().over(Window.partitionBy("id").orderBy("updated_at", "run_id"))
            was = F.when(F.col("previous") == "failure", "active").otherwise("resolved").alias("was")
            since = old.withColumn("_rank", first).where("_rank = 1").select("id", was)
            prior = prior.join(since, "id", "full_outer").select("id", F.coalesce("was", "status").alias("status"))
    transitions = folds.ci_moves(refold.rows, prior).persist()
    changed = folds.ci_incidents(transitions)
    run.stage(table, changed if current is None else merge_ci(current, changed))
    at = deltas.period(F.col("updated_at"), filed)
    gone = deltas.change(run, changes, transitions, old, ["id", "updated_at", "run_id", "action", "previous"], at)
    replaced = None if old is None else folds.ci_outbox(old)
    stage_notices(run, folds.ci_outbox(transitions), f"{table}_notices", replaced, (*IDENTITY, "summary"), filed)  # runs may end at one time
    for held in (transitions, old, gone):
        if held is not None:
            held.unpersist()
    refold.done()


def merge_ci(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """A failure replaces the stored row; a lone success keeps its texts and start and closes it."""
    old, new = stored.alias("old"), changed.alias("new")
    joined = old.join(new, F.col("old.id") == F.col("new.id"), "full_outer")
    given = F.col("new.id").isNotNull()
    columns = []
    for name in folds.INCIDENT:
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        changes_always = name in ("status", "resolved_at")
        value = F.when(given, after).otherwise(before) if changes_always else F.coalesce(after, before)
        columns.append(value.alias(name))
    return joined.select(*columns)


def maintain_probes(
    probes: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None, table: str = "probe_incidents"
) -> StreamingQuery:
    """All outages, filed by the date they ended, plus the small table of those still open."""

    def fold(batch: DataFrame, run: Run) -> None:
        fold_probes(run, batch, table)

    return _each_batch(probes, store, f"{table}-stream", fold, checkpoint, trigger)


def fold_probes(run: Run, batch: DataFrame, table: str = "probe_incidents") -> None:
    """Stage what a batch of probes opens, closes and withdraws.

    An outage that a batch can change is still open or ended in one of the slices folded anew, so only the folder of open
    outages and those of dates since the first slice are read.
    """
    refold = Refold(run, batch, table, ["component"], "probe_ts", "probe_id")
    if refold.first is None:
        return refold.done()
    parts = _parts_from(run, table, "closed_on", refold.first)
    stored = run.store.read(table, parts) if parts else None
    carried, old = None, None
    if stored is not None:
        stored = stored.select(*folds.INCIDENT)
        ends_later = F.col("resolved_at").isNull() | ~_before("resolved_at", "first")
        old = refold.of_touched(stored).where(ends_later).persist()
        # at most one outage of a component began before its first slice and ended in it or later
        spanning = old.where(_before("created_at", "first")).select(*folds.INCIDENT)
        prior = spanning.withColumn("status", F.lit("active"))
        opened = folds.probe_incidents(refold.rows, prior=prior)
        recovered = folds.probe_recoveries(refold.rows).withColumnRenamed("component", "_component")
        carried = prior.join(recovered, F.col("component").eqNullSafe(F.col("_component")), "left").select(
            *(name for name in folds.INCIDENT if name not in ("status", "resolved_at")),
            F.when(F.col("recovered_at").isNull(), "active").otherwise("resolved").alias("status"),
            F.col("recovered_at").alias("resolved_at"),
        )
        found = opened.unionByName(carried).persist()
        kept = stored.join(old.select("id"), "id", "left_anti").unionByName(found)
    else:
        kept = found = folds.probe_incidents(refold.rows).persist()
    _replace(run, table, parts, kept.withColumn("closed_on", utc_day(F.col("resolved_at"))), "closed_on")
    run.stage(f"{table}_open", kept.where(F.col("status") == "active").select(*folds.INCIDENT))
    stage_notices(run, folds.probe_outbox(found), f"{table}_notices", None if old is None else folds.probe_outbox(old.select(*folds.INCIDENT)))
    for held in (found, old):
        if held is not None:
            held.unpersist()
    refold.done()
