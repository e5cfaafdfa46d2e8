"""Exact top-k inner-product search by distributed histogram selection.

Every query is scored against every row, in blocks. Per-query histograms of the scores are summed over all blocks and
refined around the k-th value until the histogram's cells are one score wide. Then only scores at or above the k-th value
leave their block, and ties are broken by the smaller id. No score list is ever gathered.

Defined cases: a vector that is null, empty, or holds a null or non-finite component takes no part, nor does a null id.
Vectors of different lengths never meet. A row is never its own partner, and rows that repeat a query's id count as that
query's own. A repeated query row gets its results once per row. A query without partners gets no row; an empty table gives none.
Scores are exact in the whole range of a long; one beyond it is held at the end of the range. A row of which ``scale`` times
a component is beyond a double takes no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.session import written

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
#: Cells of a refined histogram, and rows of queries multiplied at once.
CELLS = 4096
STRIP = 256
LONG = np.iinfo(np.int64)

BLOCK = "block long, dim int, n int, ids binary, width int, cells binary, top double"


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id`` and scale * component of the usable vectors; the floor is taken when blocks are packed."""
    whole = f"forall(embedding, x -> x is not null and not isnan(x) and abs(x * double({scale})) < double('inf'))"
    usable = F.expr(f"size(embedding) > 0 and {whole}")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable
    ).select("vec_id", F.transform("embedding", lambda x: x.cast("double") * scale).alias("cells"))


def _packed(block: int, ids: np.ndarray, cells: np.ndarray) -> dict:
    top = float(np.abs(cells).max())
    kind = next((t for t, m in (("<i2", 2**15 - 1), ("<i4", 2**31 - 1)) if top <= m), "<f8")
    cells = cells.astype(kind)
    return {
        "block": block, "dim": cells.shape[1], "n": len(ids), "ids": ids.astype("<i8").tobytes(),
        "width": -8 if kind == "<f8" else cells.itemsize, "cells": cells.tobytes(), "top": top,
    }


def blocks(size: int):
    """Packer of rows into blocks of at most ``size`` vectors of one length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()),
                            ("width", pa.int32()), ("cells", pa.binary()), ("top", pa.float64())])
        held: dict[int, list] = {}

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal serial
            parts = held.pop(dim)
            serial += 1
            row = _packed(serial, np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts]))
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            column = batch.column("cells")
            offsets = column.offsets.to_numpy()
            flat = column.values.to_numpy(zero_copy_only=False)
            dims = np.diff(offsets)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), size):
                    part = rows[at : at + size]
                    cells = np.floor(flat[offsets[part][:, None] + np.arange(dim)])
                    if sum(len(a) for a, _ in held.get(int(dim), [])) + len(part) > size:
                        yield flush(int(dim))
                    held.setdefault(int(dim), []).append((ids[part], cells))
        for dim in list(held):
            yield flush(dim)

    return pack


def _opened(table: pa.Table) -> tuple[np.ndarray, np.ndarray, float]:
    row = {name: table.column(name)[0].as_py() for name in ("ids", "n", "dim", "width", "cells", "top")}
    kind = "<f8" if row["width"] < 0 else f"<i{row['width']}"
    cells = np.frombuffer(row["cells"], kind).reshape(row["n"], row["dim"])
    return np.frombuffer(row["ids"], "<i8"), cells, row["top"]


def scores(q: np.ndarray, c: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer products: in doubles while every sum stays below 2**53, else in Python's integers."""
    if bound < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    product = whole(q.astype(object)).astype(object) @ whole(c.astype(object)).astype(object).T
    return np.clip(product, LONG.min, LONG.max).astype(np.int64)


def _strips(q: pa.Table, c: pa.Table, k: int):
    """Per strip of queries: first row, scores, and a mask of pairs that count."""
    q_ids, q_cells, q_top = _opened(q)
    c_ids, c_cells, c_top = _opened(c)
    bound = q_top * c_top * q_cells.shape[1]
    for at in range(0, len(q_ids), STRIP):
        found = scores(q_cells[at : at + STRIP], c_cells, bound)
        yield at, found, c_ids[None, :] != q_ids[at : at + STRIP, None], q_ids, c_ids


def count_cells(k: int):
    """Histogram of one pair of blocks over each query's current interval.

    Cells below the block's own k-th value are left out: the global k-th value is never below a block's.
    """

    def count(q: pa.Table, c: pa.Table) -> pa.Table:
        out = {"q_block": [], "q_row": [], "cell": [], "hits": []}
        if q.num_rows and c.num_rows:
            low = np.frombuffer(q.column("low")[0].as_py(), "<i8")
            width = np.frombuffer(q.column("step")[0].as_py(), "<i8")
            for at, found, mine, _, _ in _strips(q, c, k):
                for i in range(len(found)):
                    step = int(width[at + i])
                    values = found[i][mine[i]]
                    values = values[values >= low[at + i]]
                    if len(values) > k:
                        values = np.partition(values, len(values) - k)[len(values) - k :]
                    # distances fill the range of an unsigned long; all that lies above the interval is one cell
                    distance = values.astype(np.uint64) - low[at + i].astype(np.uint64)
                    cell, hits = np.unique(np.minimum(distance // np.uint64(step), np.uint64(CELLS)), return_counts=True)
                    out["q_row"].append(np.full(len(cell), at + i))
                    out["cell"].append(cell)
                    out["hits"].append(hits)
        rows = sum(map(len, out["cell"]))
        columns = {n: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for n, v in out.items() if n != "q_block"}
        block = q.column("block")[0].as_py() if q.num_rows else 0
        return pa.table({"q_block": np.full(rows, block, np.int64), **columns})

    return count


def pick(k: int):
    """Pairs of one pair of blocks that score above the k-th value, and the smallest k ids of those that equal it."""

    def keep(q: pa.Table, c: pa.Table) -> pa.Table:
        out: dict[str, list] = {"q_block": [], "q_row": [], "query_id": [], "vec_id": [], "score": []}
        if q.num_rows and c.num_rows:
            floor = np.frombuffer(q.column("low")[0].as_py(), "<i8")
            block = q.column("block")[0].as_py()
            for at, found, mine, q_ids, c_ids in _strips(q, c, k):
                for i in range(len(found)):
                    above = np.flatnonzero((found[i] > floor[at + i]) & mine[i])
                    ties = np.flatnonzero((found[i] == floor[at + i]) & mine[i])
                    if len(ties) > k:
                        ties = ties[np.argpartition(c_ids[ties], k)[:k]]
                    rows = np.concatenate([above, ties])
                    out["q_block"].append(np.full(len(rows), block))
                    out["q_row"].append(np.full(len(rows), at + i))
                    out["query_id"].append(np.full(len(rows), q_ids[at + i]))
                    out["vec_id"].append(c_ids[rows])
                    out["score"].append(found[i][rows])
        return pa.table({n: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for n, v in out.items()})

    return keep


def exact_topk(queries: DataFrame, candidates: DataFrame, k: int, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest-scoring candidates.

    Both inputs have ``vec_id`` and ``embedding``. Blocks of queries meet blocks of candidates by an equi-join on the
    number of the pair, so the work spreads over as many tasks as there are pairs.
    """
    spark = candidates.sparkSession
    c_blocks = written(quantised(candidates, scale).mapInArrow(blocks(CANDIDATE_BLOCK), BLOCK), "topk-candidates")
    found = written(quantised(queries, scale), "topk-queries")
    gathered = found.repartition(max(1, -(-found.count() // QUERY_BLOCK)), F.xxhash64("vec_id"))
    q_blocks = written(gathered.mapInArrow(blocks(QUERY_BLOCK), BLOCK), "topk-queries")

    bounds = q_blocks.groupBy("dim").agg(F.max("top").alias("q_top")).join(
        c_blocks.groupBy("dim").agg(F.max("top").alias("c_top")), "dim"
    ).agg(F.max(F.col("q_top") * F.col("c_top") * F.col("dim"))).first()[0]
    bound = int(min(bounds or 0.0, 2.0**63))
    step = max(1, -(-(2 * bound + 1) // CELLS))

    pairs = q_blocks.select("block", "dim").join(c_blocks.select(F.col("block").alias("c_block"), "dim"), "dim")
    c_dealt = c_blocks.join(pairs.withColumnRenamed("block", "q_block").select("q_block", "c_block"),
                            F.col("block") == F.col("c_block")).drop("c_block")

    def meet(state: DataFrame, work, schema: str) -> DataFrame:
        q_dealt = state.join(pairs.select("block", "c_block"), "block")
        return q_dealt.groupBy("block", "c_block").cogroup(c_dealt.groupBy("q_block", "block")).applyInArrow(work, schema)

    filled = F.udf(lambda n, value: np.full(n, value, "<i8").tobytes(), "binary")
    state = q_blocks.withColumn("low", filled("n", F.lit(-bound))).withColumn("step", filled("n", F.lit(step)))
    while True:
        cells = meet(state, count_cells(k), "q_block long, q_row long, cell long, hits long")
        per_query = Window.partitionBy("q_block", "q_row").orderBy(F.desc("cell"))
        summed = cells.groupBy("q_block", "q_row", "cell").agg(F.sum("hits").alias("hits"))
        # the interval starts at the cell where the count from above reaches k (all cells, if it never does)
        reached = summed.withColumn("upto", F.sum("hits").over(per_query)).withColumn("before", F.col("upto") - F.col("hits"))
        cut = reached.where(F.col("before") < k).groupBy("q_block", "q_row").agg(F.min("cell").alias("cell"))
        chosen = cut.groupBy("q_block").agg(F.collect_list(F.struct("q_row", "cell")).alias("cut"))
        state = written(_refined(state, chosen), "topk-state")
        if step == 1:
            break
        step = max(1, -(-step // CELLS))
    rows = meet(state, pick(k), "q_block long, q_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _refined(state: DataFrame, chosen: DataFrame) -> DataFrame:
    """Each block's intervals, narrowed to the chosen cells (a block holds at most QUERY_BLOCK queries)."""
    columns = state.columns

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                low = np.frombuffer(row["low"], "<i8").copy()
                step = np.frombuffer(row["step"], "<i8").copy()
                for hit in row.pop("cut") or []:
                    i = hit["q_row"]
                    low[i] = int(low[i]) + hit["cell"] * int(step[i])
                row["low"], row["step"] = low.tobytes(), np.maximum(1, -(-step // CELLS)).tobytes()
            fields = [batch.schema.field(name) for name in columns]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    joined = state.join(chosen.withColumnRenamed("q_block", "block"), "block", "left")
    return joined.select(*columns, "cut").mapInArrow(narrow, state.schema)


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """Top-k of the rows whose id is divisible by ``every``, against all rows."""
    return exact_topk(vectors.where(F.col("vec_id") % every == 0), vectors, k, scale)
