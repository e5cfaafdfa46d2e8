"""Tables that grow by what each run adds, filed by period and merged when they are read.

A run writes one folder for each period (a date or a month) that its rows fall into, next to those of earlier runs, so what
it writes follows its own rows and not the period's. Periods with many folders are merged now and then. All of it goes
through the store's manifest, so a reader sees a run's folders with everything else that the run publishes.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.functions.clock import label
from beaconlake.plans.publish import Run, Store

PART = "part"
DAY, MONTH = "yyyy-MM-dd", "yyyy-MM"
#: Period of rows without a time; it comes before all others.
NEVER = "0"
#: Folders of a period beyond which a run merges them.
MOST = 64


def period(at: Column, pattern: str = DAY) -> Column:
    return F.coalesce(label(at, pattern), F.lit(NEVER))


def _parts(names: list[str], first: str | None, only: set[str] | None = None) -> list[str]:
    """Folders of the periods from one on, or of some periods."""
    kept = [p for p in names if first is None or p >= f"{PART}={first}"]
    return kept if only is None else [p for p in kept if _period(p) in only]


def _period(part: str) -> str:
    return part.removeprefix(f"{PART}=").split("~")[0]


def read(store: Store, table: str, first: str | None = None, only: set[str] | None = None) -> DataFrame | None:
    """Published rows of the periods from ``first`` on, or of some periods; None when there are none."""
    found = store.read(table, _parts(store.begin().parts(table), first, only))
    return None if found is None else found.drop(PART)


def add(
    run: Run, table: str, rows: DataFrame, at: Column, merged: Callable[[DataFrame], DataFrame] = lambda rows: rows, most: int = MOST
) -> None:
    """Stage rows in folders of their own, by the period ``at``; once for a table and run.

    Periods that had more than ``most`` folders before the run get one instead, with the rows that ``merged`` makes of them.
    """
    before = [part for kind, name, part in run.base if (kind, name) == ("table", table)]
    before = [part for part in before if part in run.parts(table)]
    crowded = {p for p, n in Counter(map(_period, before)).items() if n > most}
    if crowded:
        old = _parts(before, None, crowded)
        rows = merged(run.store.read(table, old).drop(PART)).select(*rows.columns).unionByName(rows)
        run.drop(table, old)
    named = rows.withColumn(PART, F.concat(at, F.lit(f"~{uuid.uuid4().hex}")))
    run.stage(table, named.hint("rebalance", PART), PART)


def change(run: Run, table: str, new: DataFrame, old: DataFrame | None, identity: list[str], at: Column) -> DataFrame | None:
    """Stage ``new`` in place of the published rows ``old``; returns those that ``new`` does not repeat, persisted.

    ``identity`` names the columns that tell rows apart. As a rule nothing is taken back, and only what is not published yet
    is written; else the periods of what goes are written anew.
    """
    if old is None:
        add(run, table, new, at)
        return None

    def without(left: DataFrame, right: DataFrame) -> DataFrame:
        same = [F.col(f"left.{c}").eqNullSafe(F.col(f"right.{c}")) for c in identity]
        return left.alias("left").join(right.alias("right"), same, "left_anti")

    gone = without(old, new).persist()
    periods = {row[0] for row in gone.select(at).distinct().collect()}
    if periods:
        stays = without(read(run.store, table, only=periods), gone)
        run.drop(table, _parts(run.parts(table), None, periods))
        add(run, table, stays.unionByName(without(new, old)), at)
    else:
        add(run, table, without(new, old), at)
    return gone
