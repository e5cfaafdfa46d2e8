"""Ordered per-key lookups that do not put a whole key into one task.

Incident folds need, for a row, the state just before it and the next row of some kind after it. A window over the
whole key would sort one component's full history in a single task. Here each key is cut into time slices. A window inside
a slice finds what it can; what a slice means to its neighbours is its summary: the last state in it and the first row of
that kind. Summaries are associative, so a scan over the slices of a key gives the state before and the row after each.

Rows are read and shuffled once, by key and slice. Only the rows that a fold still wants are kept after the window, the first
of each slice carries the summary, and these few rows are checkpointed, as the scan and the result both need them.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from beaconlake.session import checkpointed

SLICE = timedelta(hours=1)


def with_neighbours(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    previous: Column | None = None,
    following: Column | None = None,
    width: timedelta = SLICE,
    wanted: Column | None = None,
) -> DataFrame:
    """Add ``previous`` and/or ``following``: per row and key, the last non-NULL value of the ``previous`` expression
    among earlier rows, and the first non-NULL value of the ``following`` expression among later rows.

    ``order`` names the ordering columns; the first is a timestamp, and together they must order a key totally. ``wanted``
    is a condition on the rows that the caller needs. It may use ``previous``, which is still NULL then where the slice has
    no earlier value, and ``slice_window``.
    """
    # Integer slice number: the remainder is taken off first so that no rounding moves a row across a slice border.
    micros, size = F.unix_micros(order[0]), width // timedelta(microseconds=1)
    # In a struct a NULL key equals itself, in windows and joins alike.
    # Rows without a time come first, in a slice of their own.
    number = F.coalesce(micros - F.pmod(micros, F.lit(size)), F.lit(-(2**63)))
    sliced = rows.withColumn("_key", F.struct(*keys)).withColumn("_slice", number)
    in_slice, across = Window.partitionBy("_key", "_slice"), Window.partitionBy("_key")
    before = (Window.unboundedPreceding, -1)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    forwards = in_slice.orderBy(*order)

    near, summary, carried, names = [], [], [], []
    if previous is not None:
        sliced = sliced.withColumn("_prev", previous)
        near.append(F.last("_prev", ignorenulls=True).over(forwards.rowsBetween(*before)).alias("previous"))
        summary.append(F.last("_prev", ignorenulls=True).over(forwards.rowsBetween(*whole)).alias("_last"))
        carried.append(F.last("_last", ignorenulls=True).over(across.orderBy("_slice").rowsBetween(*before)).alias("_far_previous"))
        names.append("previous")
    if following is not None:
        sliced = sliced.withColumn("_next", following)
        backwards = in_slice.orderBy(*(F.col(name).desc() for name in order))
        near.append(F.last("_next", ignorenulls=True).over(backwards.rowsBetween(*before)).alias("following"))
        summary.append(F.first("_next", ignorenulls=True).over(forwards.rowsBetween(*whole)).alias("_first"))
        carried.append(
            F.last("_first", ignorenulls=True).over(across.orderBy(F.col("_slice").desc()).rowsBetween(*before)).alias("_far_following")
        )
        names.append("following")

    placed = sliced.select("*", *near, *summary, F.row_number().over(forwards).alias("_row"))
    placed = placed.withColumn("_wanted", F.lit(True) if wanted is None else F.coalesce(wanted, F.lit(False)))
    kept = checkpointed(placed.where(F.col("_wanted") | (F.col("_row") == 1)))
    slices = kept.where("_row = 1").select("_key", "_slice", *carried)
    return kept.where("_wanted").join(slices, ["_key", "_slice"], "left").select(
        *rows.columns, *(F.coalesce(name, f"_far_{name}").alias(name) for name in names)
    )


def slice_window(*keys: str) -> WindowSpec:
    """Rows of one slice of a key that share more keys, for use in a ``wanted`` condition."""
    return Window.partitionBy("_key", "_slice", *keys)


def rolling_sum(
    rows: DataFrame, keys: list[str], at: str, value: str, span: timedelta, width: timedelta = SLICE
) -> DataFrame:
    """Add ``rolling``: per row and key, the sum of ``value`` over rows with time in [at - span, at], ties included.

    ``span`` is a multiple of ``width``. Within one slice the sum is: the totals of the ``span / width`` slices before
    it, minus rows that have left the window by now, plus rows of the slice so far. So every row takes part in two
    slices, once entering and once leaving, and a window partition never holds more than two slices of a key.
    """
    micro = timedelta(microseconds=1)
    size, slices = width // micro, span // width
    if slices * width != span:
        raise ValueError("span must be a multiple of the slice width")
    base = rows.withColumn("_us", F.unix_micros(at)).withColumn("_slice", F.col("_us") - F.pmod("_us", F.lit(size)))
    amount = F.coalesce(F.col(value), F.lit(0)).cast("bigint")
    carried = [field for field in rows.schema.fields if field.name not in keys]

    def step(slice_: Column, us: Column, delta: Column, own: bool) -> list[Column]:
        blank = F.lit(None)
        return [
            slice_.alias("_slice"),
            us.alias("_us"),
            delta.alias("_delta"),
            F.lit(own).alias("_own"),
            *((F.col(f.name) if own else blank.cast(f.dataType)).alias(f.name) for f in carried),
        ]

    span_us = span // micro
    # One scan yields both steps. A row at t counts up to and including t + span, hence leaves one microsecond later.
    entering = step(F.col("_slice"), F.col("_us"), amount, True)
    leaving = step(F.col("_slice") + span_us, F.col("_us") + span_us + 1, -amount, False)
    steps = base.select(*keys, F.inline(F.array(F.struct(*entering), F.struct(*leaving))))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(-span_us, -size)
    before = F.coalesce(F.sum("_total").over(earlier), F.lit(0))
    totals = (
        base.groupBy(*keys, "_slice")
        .agg(F.sum(amount).alias("_total"))
        .select(*keys, *step(F.col("_slice"), F.col("_slice"), before, False))
    )
    so_far = Window.partitionBy(*keys, "_slice").orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    return (
        steps.unionByName(totals)
        .withColumn("rolling", F.sum("_delta").over(so_far))
        .where("_own")
        .select(*rows.columns, "rolling")
    )
