"""Hard negatives of anchors, by exact scores from a residue-number-system matrix product.

Blocks of anchors meet blocks of rows. A product of two blocks is taken modulo several small primes, each in float32:
residues are centred on zero and columns are taken in strips, so that no partial sum leaves the 24 bits in which float32 is
exact. Mixed-radix Chinese remaindering then gives the signed scores, from as many primes as the blocks' largest possible
score asks for. The first round keeps each anchor's best rows of its own label in every block; a window over what the blocks
sent ranks them as positives. The second round keeps, for each positive, the best rows of other labels inside the
positive's window of scores, and a second window ranks these. No score list is ever gathered.

Defined cases: a row takes no part if its id, label or vector is null, if the vector is empty or holds a null or non-finite
component, or if ``scale`` times a component is beyond a double. Vectors of different lengths never meet. Rows that repeat
an anchor's id are the anchor's own: neither its positives nor its negatives. A repeated row counts once for each time it
stands there, as an anchor too. Equal scores go by the smaller id. Scores are exact in the whole range of a long; one
beyond it is held at the end of the range, and the window of scores is taken of what is held. A positive of negative score
has an empty window. An anchor without positives, and a positive without negatives, has no row; an empty table gives none.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.session import written

#: Rows of a block at most, and bytes of its cells at most; anchors multiplied at once.
ANCHORS = 2048
ROWS = 4096
BLOCK_BYTES = 16 << 20
STRIP = 128
LABELS = 10

BLOCK = "block long, dim int, n int, ids binary, labels binary, width int, cells binary, top double"
BLOCK_SCHEMA = pa.schema([
    ("block", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
    ("width", pa.int32()), ("cells", pa.binary()), ("top", pa.float64()),
])
LONG = np.iinfo(np.int64)


@functools.cache
def primes() -> tuple[int, ...]:
    """Primes below 2,048: those of one byte first, largest first, as they allow the widest strips for their size."""
    sieve = np.ones(2048, bool)
    sieve[:2] = False
    for n in range(2, 46):
        if sieve[n]:
            sieve[n * n :: n] = False
    found = np.flatnonzero(sieve).tolist()
    return tuple([p for p in found[::-1] if p < 256] + [p for p in found if p > 256])


def moduli(bound: int) -> list[int]:
    """Primes whose product tells all integers from -bound to bound apart."""
    chosen, product = [], 1
    for p in primes():
        if product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    else:
        raise ValueError(f"no primes are left for scores up to {bound}")
    return chosen


def residues(cells: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers modulo ``p`` as float32 between -p/2 and p/2. The remainder of doubles is exact."""
    rest = np.fmod(cells.astype(np.float64), p)
    return (rest - p * np.rint(rest / p)).astype(np.float32)


def product_modulo(q: np.ndarray, c: np.ndarray, p: int) -> np.ndarray:
    """q times c transposed modulo ``p``, from centred residues, exactly in float32."""
    strip = (2**24 - p) // (p // 2) ** 2 if p > 3 else 2**22
    total = np.zeros((len(q), len(c)), np.float32)
    for at in range(0, q.shape[1], strip):
        total = np.fmod(total + q[:, at : at + strip] @ c[:, at : at + strip].T, np.float32(p))
    return np.mod(total.astype(np.int64), p)


def remaindered(rests: list[np.ndarray], chosen: list[int]) -> np.ndarray:
    """The signed integers with these rests modulo the chosen primes, held inside the range of a long."""
    digits: list[np.ndarray] = []
    for rest, p in zip(rests, chosen):
        for digit, before in zip(digits, chosen):
            rest = (rest - digit) * pow(before, -1, p) % p
        digits.append(rest)
    whole = 1
    for p in chosen:
        whole *= p
    value = digits[-1] if whole < 2**62 else digits[-1].astype(object)
    for digit, p in zip(digits[-2::-1], chosen[-2::-1]):
        value = value * p + digit
    value = np.where(value > whole // 2, value - whole, value)
    return value if value.dtype == np.int64 else np.clip(value, LONG.min, LONG.max).astype(np.int64)


def usable(vectors: DataFrame, relabel: int, scale: int) -> DataFrame:
    """``vec_id, label, cells`` of the rows that take part; cells are ``scale`` times the components, not yet floored."""
    whole = F.expr(f"forall(embedding, x -> x is not null and not isnan(x) and abs(x * double({scale})) < double('inf'))")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % relabel == 0, (label + 1) % LABELS).otherwise(label)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & whole
    )
    return rows.select("vec_id", moved.alias("label"), F.transform("embedding", lambda x: x.cast("double") * scale).alias("cells"))


def _packed(block: int, parts: list[tuple]) -> dict:
    ids, labels, cells = (np.concatenate(p) for p in zip(*parts))
    top = float(np.abs(cells).max())
    kind = next((t for t, most in (("<i2", 2**15 - 1), ("<i4", 2**31 - 1)) if top <= most), "<f8")
    cells = cells.astype(kind)
    return {
        "block": block, "dim": cells.shape[1], "n": len(ids), "ids": ids.astype("<i8").tobytes(),
        "labels": labels.astype("<i8").tobytes(), "width": -8 if kind == "<f8" else cells.itemsize,
        "cells": cells.tobytes(), "top": top,
    }


def blocks(most: int):
    """Packer of rows into blocks of vectors of one length: ``most`` rows and BLOCK_BYTES of doubles at most."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}
        count: dict[int, int] = {}

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal serial
            serial += 1
            count.pop(dim)
            return pa.RecordBatch.from_pylist([_packed(serial, held.pop(dim))], schema=BLOCK_SCHEMA)

        for batch in batches:
            ids, labels = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "label"))
            column = batch.column("cells")
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            dims = np.diff(offsets)
            for dim in np.unique(dims).tolist():
                size = max(1, min(most, BLOCK_BYTES // (8 * dim)))
                rows = np.flatnonzero(dims == dim)
                while len(rows):
                    part, rows = np.split(rows, [size - count.get(dim, 0)])
                    cells = np.floor(flat[offsets[part][:, None] + np.arange(dim)])
                    held.setdefault(dim, []).append((ids[part], labels[part], cells))
                    count[dim] = count.get(dim, 0) + len(part)
                    if count[dim] >= size:
                        yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return pack


class Block:
    """One row of a table of blocks."""

    def __init__(self, table: pa.Table):
        row = {name: table.column(name)[0].as_py() for name in BLOCK_SCHEMA.names}
        kind = "<f8" if row["width"] < 0 else f"<i{row['width']}"
        self.block, self.top = row["block"], row["top"]
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.cells = np.frombuffer(row["cells"], kind).reshape(row["n"], row["dim"])


def scored(anchors: Block, rows: Block) -> Iterator[tuple[int, np.ndarray]]:
    """Strips of exact scores: first anchor of the strip, anchors by rows."""
    chosen = moduli(int(anchors.top) * int(rows.top) * anchors.cells.shape[1])
    right = [residues(rows.cells, p) for p in chosen]
    for at in range(0, len(anchors.ids), STRIP):
        cells = anchors.cells[at : at + STRIP]
        rests = [product_modulo(residues(cells, p), c, p) for c, p in zip(right, chosen)]
        yield at, remaindered(rests, chosen) if chosen else np.zeros((len(cells), len(rows.ids)), np.int64)


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids, in order."""
    place = np.arange(len(scores))
    if len(scores) > k:
        place = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return place[np.lexsort((ids[place], -1 - scores[place]))][:k]  # -1 - x reverses the order without overflow


POSITIVES = "a_block long, a_row int, anchor_id long, positive_id long, positive_score long"
NEGATIVES = "a_block long, a_row int, slot int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _table(parts: list[tuple], kinds: list[tuple]) -> pa.Table:
    """Parts are tuples of arrays, one for each column."""
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64) for _ in kinds]
    return pa.table({n: pa.array(c.astype(t)) for (n, t), c in zip(kinds, columns)})


def block_positives(k: int):
    """Each anchor's ``k`` first rows of its label among one block."""
    kinds = [("a_block", "i8"), ("a_row", "i4"), ("anchor_id", "i8"), ("positive_id", "i8"), ("positive_score", "i8")]

    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        parts = []
        if a.num_rows and c.num_rows:
            anchors, rows = Block(a), Block(c)
            for at, found in scored(anchors, rows):
                for i, scores in enumerate(found, at):
                    mine = np.flatnonzero((rows.labels == anchors.labels[i]) & (rows.ids != anchors.ids[i]))
                    mine = mine[first(scores[mine], rows.ids[mine], k)]
                    fixed = [np.full(len(mine), x) for x in (anchors.block, i, anchors.ids[i])]
                    parts.append((*fixed, rows.ids[mine], scores[mine]))
        return _table(parts, kinds)

    return run


def least_score(positive: np.ndarray, percent: int) -> np.ndarray:
    """The smallest n with 100 * n >= percent * positive, without leaving the range of a long."""
    whole, rest = positive // 100, positive % 100
    return whole * percent + -(-rest * percent // 100)


def block_negatives(k: int, percent: int):
    """For each positive of each anchor, the ``k`` first rows of other labels in the positive's window, of one block."""
    kinds = [(n, "i4" if n in ("a_row", "slot") else "i8") for n in (f.split()[0] for f in NEGATIVES.split(", "))]

    def run(a: pa.Table, c: pa.Table) -> pa.Table:
        parts = []
        if a.num_rows and c.num_rows:
            anchors, rows = Block(a), Block(c)
            state: dict[int, list] = {}
            for p in a.column("positives")[0].as_py() or []:
                state.setdefault(p["a_row"], []).append((p["slot"], p["positive_id"], p["positive_score"]))
            for at, found in scored(anchors, rows):
                for i, scores in enumerate(found, at):
                    if i not in state:
                        continue
                    high = np.array([s for _, _, s in state[i]], np.int64)
                    low = least_score(high, percent)
                    other = (rows.labels != anchors.labels[i]) & (rows.ids != anchors.ids[i])
                    near = np.flatnonzero(other & (scores >= low.min()) & (scores <= high.max()))
                    for (slot, positive, top), least in zip(state[i], low.tolist()):
                        mine = near[(scores[near] >= least) & (scores[near] <= top)]
                        mine = mine[first(scores[mine], rows.ids[mine], k)]
                        fixed = [np.full(len(mine), x) for x in (anchors.block, i, slot, anchors.ids[i], positive, top)]
                        parts.append((*fixed, rows.ids[mine], scores[mine]))
        return _table(parts, kinds)

    return run


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, percent: int = 80, relabel: int = 7, scale: int = 256
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``embedding`` and ``label``; ``anchors`` is a condition on ``vec_id``. Labels of ids
    divisible by ``relabel`` move on by one. A negative scores from ``percent`` of the positive's score up to that score.
    """
    rows = usable(vectors, relabel, scale)
    c_blocks = written(rows.mapInArrow(blocks(ROWS), BLOCK), "negatives-rows")
    chosen = written(rows.where(anchors), "negatives-anchors")
    gathered = chosen.repartition(max(1, -(-chosen.count() // ANCHORS)), F.xxhash64("vec_id"))
    a_blocks = written(gathered.mapInArrow(blocks(ANCHORS), BLOCK), "negatives-anchors")
    pairs = a_blocks.select(F.col("block").alias("a"), "dim").join(c_blocks.select(F.col("block").alias("c"), "dim"), "dim").drop("dim")
    c_dealt = c_blocks.join(pairs, c_blocks["block"] == pairs["c"]).drop("c")

    def meet(state: DataFrame, work, schema: str) -> DataFrame:
        a_dealt = state.join(pairs, state["block"] == pairs["a"]).drop("a")
        return a_dealt.groupBy("block", "c").cogroup(c_dealt.groupBy("a", "block")).applyInArrow(work, schema)

    best = Window.partitionBy("a_block", "a_row").orderBy(F.desc("positive_score"), "positive_id")
    found = meet(a_blocks, block_positives(positives), POSITIVES).withColumn("slot", F.row_number().over(best))
    found = found.where(F.col("slot") <= positives)
    # a block holds at most ANCHORS anchors, and each of them at most ``positives`` rows here
    listed = found.groupBy(F.col("a_block").alias("block")).agg(
        F.collect_list(F.struct("a_row", "slot", "positive_id", "positive_score")).alias("positives")
    )
    state = written(a_blocks.join(listed, "block"), "negatives-positives")
    hits = meet(state, block_negatives(negatives, percent), NEGATIVES)
    order = Window.partitionBy("a_block", "a_row", "slot").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(vectors: DataFrame, every: int = 100) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``, against all rows."""
    return hard_negatives(vectors, F.col("vec_id") % every == 0)
