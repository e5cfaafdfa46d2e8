"""Packing of token pieces into fixed-length sequences by pattern fitting with non-negative least squares.

The histogram of piece lengths is the whole problem: it has one cell for each length up to the sequence length. Patterns
of up to ``deep`` lengths that fill a sequence exactly are enumerated, repeat counts are fitted to the histogram by
non-negative least squares, and rounded down to what the histogram can pay. What is left is packed best-fit, longest first,
on counts as well. The result is a plan of rank intervals: of the pieces of one length, those ranked from ``a`` to ``b`` go,
one each, to consecutive sequences at one offset. A rank is the piece's place in its task plus the counts of the tasks
before, so no length, however common, is sorted or gathered in one place.

Defined cases: a null text counts as empty and gives one piece with the end id. A text of more than one sequence is cut so
that all pieces but the first are full. Repeated rows and null doc_ids are packed like others. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.llm.common import raw_texts, texts, tidy
from beaconlake.llm.tokens import encoder
from beaconlake.session import written

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("part", pa.int32()), ("place", pa.int64())])
PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, size: int) -> DataFrame:
    """Every document's pieces, with the task that made each and the piece's place among that task's of equal length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer_path).encode
        seen: Counter[int] = Counter()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), encode(raw_texts(batch))):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % size + 1
                starts = [0, *range(first, len(ids), size)]
                for number, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((doc_id, number, a, b - a, zlib.crc32(ids[a:b].tobytes()), part, seen[b - a]))
                    seen[b - a] += 1
            columns = list(zip(*rows)) or [[] for _ in PIECE]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECE)], schema=PIECE)

    return texts(docs).mapInArrow(tidy(run, "encoder"), PIECE_DDL)


def patterns(present: np.ndarray, size: int) -> np.ndarray:
    """All patterns of one to three present lengths that sum to ``size``, as rows of lengths padded with 0."""
    has = np.zeros(size + 1, bool)
    has[present] = True
    rows = [(size, 0, 0)] if has[size] else []
    rows += [(size - b, b, 0) for b in range(1, size // 2 + 1) if has[b] and has[size - b]]
    for c in range(1, size // 3 + 1):
        if has[c]:
            b = np.arange(c, (size - c) // 2 + 1)
            a = size - c - b
            good = has[a] & has[b]
            rows += zip(a[good].tolist(), b[good].tolist(), repeat(c))
    return np.array(rows, np.int64).reshape(-1, 3)


def fit(found: np.ndarray, chosen: np.ndarray, steps: int = 600) -> np.ndarray:
    """Non-negative repeats x that minimise |A x - histogram|, by accelerated projected gradients.

    A has one column for each pattern and is used through its lengths, never stored.
    """
    size = len(found) - 1
    target = found.astype(float)
    target[0] = 0.0

    def forward(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(chosen[:, j], weights=x, minlength=size + 1) for j in range(3))
        out[0] = 0.0
        return out

    x = y = np.zeros(len(chosen))
    probe = np.ones(len(chosen))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        grown = forward(probe)[chosen].sum(1, where=chosen > 0)
        rate = float(np.linalg.norm(grown))
        probe = grown / rate
    momentum = 1.0
    for _ in range(steps):
        residual = forward(y) - target
        ahead = np.maximum(y - residual[chosen].sum(1, where=chosen > 0) / (1.05 * rate), 0.0)
        grown_momentum = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        y = ahead + (momentum - 1) / grown_momentum * (ahead - x)
        x, momentum = ahead, grown_momentum
    return x


def repeats(found: np.ndarray, chosen: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole repeats paid from the histogram, largest first: rounded, but never more than is left. Also what is left."""
    left = found.copy()
    times = np.zeros(len(chosen), np.int64)
    for i in np.argsort(-x, kind="stable"):
        need = Counter(v for v in chosen[i].tolist() if v)
        wanted = int(round(x[i]))
        take = min([wanted, *(int(left[v]) // n for v, n in need.items())])
        if take > 0:
            times[i] = take
            for v, n in need.items():
                left[v] -= n * take
    return times, left


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: equal pieces go together into equal sequences. (lengths, sequences) pairs."""
    open_by_room: dict[int, list[list]] = {}
    closed: list[tuple[tuple[int, ...], int]] = []
    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            room = next((r for r in range(length, size + 1) if open_by_room.get(r)), None)
            if room is None:
                room, bins = size, count
                each = min(size // length, count)
                bins = count // each
                content: tuple[int, ...] = ()
            else:
                content, bins = open_by_room[room].pop()
                each = min(room // length, count)
                used = min(bins, count // each)
                if used < bins:
                    open_by_room[room].append([content, bins - used])
                bins = used
            count -= each * bins
            content += (length,) * each
            room -= each * length
            if room:
                open_by_room.setdefault(room, []).append([content, bins])
            else:
                closed.append((content, bins))
    return closed + [(content, bins) for held in open_by_room.values() for content, bins in held]


def plan(found: np.ndarray, size: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, sequence of the first rank, offset) intervals that place every piece."""
    chosen = patterns(np.flatnonzero(found), size)
    groups: list[tuple[tuple[int, ...], int]] = []
    left = found.copy()
    if len(chosen):
        times, left = repeats(found, chosen, fit(found, chosen))
        groups += [(tuple(v for v in chosen[i].tolist() if v), int(times[i])) for i in np.flatnonzero(times)]
    groups += best_fit(left, size)
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for lengths, bins in groups:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], used[length] + bins, sequence, offset))
            used[length] += bins
            offset += length
        sequence += bins
    return rows


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = 1024) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document."""
    spark = docs.sparkSession
    made = written(pieces(docs, tokenizer_path, end_id, size), "pieces")
    counts = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    # one row for each task and length, so a common length has no more rows than there are tasks
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    found = np.zeros(size + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        found[row["length"]] = row["n"]
    intervals = sorted(plan(found, size))
    columns = [np.array(c, np.int64) for c in zip(*intervals)] or [np.zeros(0, np.int64)] * 5
    held = spark.sparkContext.broadcast(columns)  # bounded by the patterns of ``size``, whatever the number of documents

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, sequence, offset = held.value
        wide = np.int64(1) << 44
        keys = length * wide + first
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("place").to_numpy() + batch.column("base").to_numpy()
            at = np.searchsorted(keys, lengths * wide + ranks, side="right") - 1
            kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence[at] + ranks - first[at]), pa.array(offset[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = made.join(bases, ["length", "part"])
    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
