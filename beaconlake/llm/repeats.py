"""Removal of byte strings that another document with a smaller id has too, by distributed suffix arrays.

Every byte covered by a string of ``size`` bytes that also starts in a document with a smaller doc_id goes; strings are
judged on the input. Equal strings must meet in one task without every suffix being moved:

1. Anchors. In each string of ``size`` bytes the leftmost smallest hash of a shorter gram is its anchor, so equal strings
   have equal anchors at equal places. The strings of one anchor are consecutive; the bytes they span are its context.
2. Contexts are grouped by anchor. Of equal contexts only the one with the smallest doc_id matters: the others are covered
   whole, and are settled inside their task before the shuffle if they can be. An anchor with one context is done.
3. The remaining contexts of a group of anchors form one text. Its suffixes are sorted by the difference cover: sampled
   triples are sorted and named, names are sorted by recursion, other suffixes are merged. Adjacent prefixes of ``size``
   bytes are compared; in a run of equal ones all but those of the smallest doc_id are covered.
   A group of more than GROUP bytes takes steps 1 and 2 again inside its task, with anchors from longer grams, and sorts what
   is left in runs of whole anchors, so that a task's memory does not grow with the number of contexts that share an anchor.

Anchors with very many different contexts (where a common passage meets different neighbours) would make one group too
large. Such contexts are cut into their single strings, which are spread by their hash and combined before the shuffle.

Defined cases: a null text counts as empty. A text shorter than ``size`` keeps all its bytes. A null doc_id is larger
than every other, and documents with equal ids, null ones too, never remove anything from one another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconlake.llm.common import bounded_batches, raw_texts, tidy
from beaconlake.llm.suffixes import suffix_array
from beaconlake.session import written

SIZE = 50
GRAM = 20
#: Bytes hashed at once, suffix arrays for each group of anchors, and contexts of one anchor beyond which they are cut up.
SLICE = 2 << 20
#: Places of a slice that are worked on together, so that what is made on the way stays small.
BLOCK = 1 << 16
ARRAYS = 16
CROWD = 50_000
#: Bytes whose suffixes are sorted at once, and rows given on at once.
GROUP = 1 << 20
ROWS = 1 << 14
LAST_ID = 2**63 - 1

_odd = 0x9E3779B97F4A7C15
_inverse = pow(_odd, -1, 1 << 64)
_byte_values = np.random.default_rng(20).integers(1, 2**64, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``, from the power 0 on, modulo 2**64."""
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


_up, _down = _powers(_odd, BLOCK), _powers(_inverse, BLOCK)


class Hashes:
    """Hashes of any substring of a buffer, equal for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray):
        blocks = len(data) // BLOCK + 1
        self.heads = _powers(pow(_odd, BLOCK, 1 << 64), blocks)  # what the powers of a block are multiplied by
        below = _powers(pow(_inverse, BLOCK, 1 << 64), blocks)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        for block, at in enumerate(range(0, len(data), BLOCK)):
            own = _byte_values[data[at : at + BLOCK]]
            own *= _down[: len(own)]
            own *= below[block]
            own[:1] += self.sums[at : at + 1]
            np.cumsum(own, out=self.sums[at + 1 : at + 1 + len(own)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * (_up[start % BLOCK] * self.heads[start // BLOCK]))

    def grams(self, length: int) -> np.ndarray:
        out = np.empty(max(len(self.sums) - length, 0), np.uint64)
        for block, at in enumerate(range(0, len(out), BLOCK)):
            own = self.sums[at + length : at + length + BLOCK] - self.sums[at : min(at + BLOCK, len(out))]
            own *= _up[: len(own)]
            own *= self.heads[block]
            out[at : at + BLOCK] = mixed(own)
        return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def leftmost_smallest(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its leftmost smallest one."""
    out = np.empty(max(len(h) - width + 1, 0), np.int32)
    for at in range(0, len(out), BLOCK):
        out[at : at + BLOCK] = _leftmost_smallest(h[at : at + BLOCK + width - 1], width)
        out[at : at + BLOCK] += at
    return out


def _leftmost_smallest(h: np.ndarray, width: int) -> np.ndarray:
    value, place, reach = h, np.arange(len(h), dtype=np.int32), 1
    while reach < width:
        step = min(reach, width - reach)
        later, n = value[step:], len(value) - step
        better = later < value[:n]
        place = np.where(better, place[step:], place[:n])
        value = np.minimum(later, value[:n])
        reach += step
    return place


def anchored(joined: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int, gram: int):
    """Contexts of all anchors: document row, first string's start, number of strings, anchor hash, context hash."""
    n = len(joined) - size + 1
    if n <= 0:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2
    hashes = Hashes(joined)
    grams = hashes.grams(gram)
    place = leftmost_smallest(grams, size - gram + 1)[:n]
    inside = np.zeros(n + 1, np.int8)
    own = ends - starts >= size
    np.add.at(inside, starts[own], 1)
    np.add.at(inside, ends[own] - size + 1, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    opens = inside.copy()
    opens[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= (place[1:] != place[:-1]) | ~inside[1:]
    # a string that opens a document opens a context even if the string before has the same anchor, which it cannot
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    anchor = grams[place[first]]
    context = hashes.of(first, last + size) ^ mixed((place[first] - first).astype(np.uint64))
    row = np.searchsorted(starts, first, side="right") - 1
    return row, first - starts[row], last - first + 1, anchor, context


PARTS = pa.schema([
    ("part", pa.int32()), ("ids", pa.binary()), ("keys", pa.binary()), ("times", pa.binary()), ("anchor", pa.binary()),
    ("context", pa.binary()), ("start", pa.binary()), ("strings", pa.binary()), ("settled", pa.binary()),
])
PARTS_DDL = (
    "part int, ids binary, keys binary, times binary, anchor binary, context binary, start binary, strings binary, "
    "settled binary"
)


def _count_type(size: int) -> str:
    """Numbers of strings of a context, which are fewer than ``size``."""
    return "<u1" if size <= 255 else "<u4"


def anchors(parts: int, size: int, gram: int):
    """Anchors of each slice of documents, as arrays for each of ``parts`` groups of anchors."""

    def emit(ids: np.ndarray, keys: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
        # a row that comes again has the covers of the first
        once = np.unique(np.column_stack([ids, keys]), axis=0, return_index=True)[1]
        ids, keys, texts = ids[once], keys[once], [texts[i] for i in once]
        joined = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        row, start, strings, anchor, context = anchored(joined, starts, ends, size, gram)
        # of equal contexts all but one with the smallest id are settled here and now
        order = np.lexsort((ids[row], context))
        row, start, strings, anchor, context = (x[order] for x in (row, start, strings, anchor, context))
        new = np.concatenate([[True], context[1:] != context[:-1]]) if len(row) else np.zeros(0, bool)
        least = ids[row][new][np.cumsum(new) - 1] if len(row) else ids[:0]
        settled = ids[row] > least
        part = ((anchor >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((row, part))
        row, start, strings, anchor, context, settled, part = (
            x[order] for x in (row, start, strings, anchor, context, settled, part)
        )
        bounds = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(0, int)
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = row[a:b]
            change = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
            docs = own[change[:-1]]
            out.append({
                "part": int(part[a]), "ids": ids[docs].tobytes(), "keys": keys[docs].tobytes(),
                "times": np.diff(change).astype("<u4").tobytes(), "anchor": anchor[a:b].astype("<u4").tobytes(),
                "context": context[a:b].tobytes(), "start": start[a:b].astype("<u4").tobytes(),
                "strings": strings[a:b].astype(_count_type(size)).tobytes(), "settled": np.packbits(settled[a:b]).tobytes(),
            })
        return pa.RecordBatch.from_pylist(out, schema=PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, held, total = [], [], [], 0
        for batch in batches:
            for i, key, raw in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(), raw_texts(batch)):
                ids.append(i)
                keys.append(key)
                held.append(raw)
                total += len(raw)
                if total >= SLICE:
                    yield emit(np.array(ids, np.int64), np.array(keys, np.int64), held)
                    ids, keys, held, total = [], [], [], 0
        if held:
            yield emit(np.array(ids, np.int64), np.array(keys, np.int64), held)

    return run


def _bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The joined bytes of a binary column without nulls, and the length of each cell; no cell becomes an object."""
    data, lengths = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for chunk in column.chunks:
        _, offsets, values = chunk.buffers()
        if len(chunk):
            wide = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
            ends = np.frombuffer(offsets, wide)[chunk.offset : chunk.offset + len(chunk) + 1]
            lengths.append(np.diff(ends).astype(np.int64))
            if ends[-1] > ends[0]:
                data.append(np.frombuffer(values, np.uint8)[ends[0] : ends[-1]])
    return np.concatenate(data), np.concatenate(lengths)


def _array(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return _bytes(table.column(name))[0].view(kind)


def _cells(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary cells of the values between neighbouring bounds."""
    offsets = (bounds * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


REPLY_DDL = "id long, key long, part int, covered boolean, crowd boolean, start binary, strings binary"
REPLY = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("part", pa.int32()), ("covered", pa.bool_()),
                   ("crowd", pa.bool_()), ("start", pa.binary()), ("strings", pa.binary())])


def replies(crowd_size: int, size: int):
    """For each document of a group of anchors: the contexts that are covered whole, and those still to be compared.

    The anchors of one array are looked at together, one array after the other: what is made on the way is for those only.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, keys = _array(table, "ids", "<i8"), _array(table, "keys", "<i8")
        owner = np.repeat(np.arange(len(ids), dtype=np.uint32), _array(table, "times", "<u4"))
        anchor, context = _array(table, "anchor", "<u4"), _array(table, "context", "<u8")
        start, strings = _array(table, "start", "<u4"), _array(table, "strings", _count_type(size))
        kind = np.zeros(len(anchor), np.uint8)  # 1: covered, 2: to be compared, 3: of a crowd, 0: done
        at = 0
        for bits, n in zip(table.column("settled"), (_bytes(table.column("anchor"))[1] // 4).tolist()):
            kind[at : at + n] = np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), count=n)
            at += n
        array = (anchor % ARRAYS).astype(np.uint8)  # equal strings have equal anchors
        for number in range(ARRAYS):
            open_rows = np.flatnonzero((array == number) & (kind == 0))
            if not len(open_rows):
                continue
            order = open_rows[np.lexsort((ids[owner[open_rows]], context[open_rows], anchor[open_rows]))]
            covered, compare, kinds = _settled(ids[owner[order]], anchor[order], context[order])
            kind[order[covered]] = 1
            kind[order[compare]] = np.where(kinds[compare] > crowd_size, 3, 2)

        def answer(rows: np.ndarray, number: int, covered: bool, crowd: bool) -> pa.Table:
            """Rows of one document and slice stand together."""
            doc = owner[rows]
            bounds = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]]))
            doc = doc[bounds[:-1]]
            part = table.column("part")[0].as_py() * ARRAYS + number
            return pa.table({
                "id": ids[doc], "key": keys[doc], "part": np.full(len(doc), part, np.int32),
                "covered": np.full(len(doc), covered), "crowd": np.full(len(doc), crowd),
                "start": _cells(start[rows], bounds), "strings": _cells(strings[rows], bounds),
            }, schema=REPLY)

        out = [REPLY.empty_table()]
        if len(rows := np.flatnonzero(kind == 1)):
            out.append(answer(rows, 0, True, False))
        for crowd in (2, 3):
            for number in range(ARRAYS):
                if len(rows := np.flatnonzero((kind == crowd) & (array == number))):
                    out.append(answer(rows, number, False, crowd == 3))
        return pa.concat_tables(out)

    return run


def _settled(ids: np.ndarray, anchor: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in the order of anchors, contexts and ids: which are covered whole as their context has a smaller id too,
    which are to be compared with other contexts of their anchor, and how many contexts the anchor has."""
    new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    new = new_anchor | np.concatenate([[True], context[1:] != context[:-1]])
    covered = ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1]
    number = np.cumsum(new_anchor) - 1
    kinds = np.bincount(number, new)[number]
    return covered, ~covered & (kinds > 1), kinds


CONTEXT_DDL = "id long, key long, part int, crowd boolean, start int, bytes binary"


def contexts(size: int):
    """The bytes of the contexts that a document's replies ask for."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("part", pa.int32()), ("crowd", pa.bool_()),
                        ("start", pa.int32()), ("bytes", pa.binary())])

    def given(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            rows = zip(*(batch.column(n).to_pylist() for n in ("id", "key")), batch.column("asked"), raw_texts(batch))
            last = None
            for doc, key, asked, raw in rows:
                if (doc, key) == last:  # the same row again
                    continue
                last = doc, key
                for part in asked.as_py():
                    starts = np.frombuffer(part["start"], "<u4").tolist()
                    for at, n in zip(starts, np.frombuffer(part["strings"], _count_type(size)).tolist()):
                        out.append((doc, key, part["part"], part["crowd"], at, raw[at : at + n - 1 + size]))
                    if len(out) >= ROWS:
                        yield given(out)
                        out = []
            yield given(out)

    return run


COVER_DDL = "id long, key long, start binary, strings binary"
COVER = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("start", pa.binary()), ("strings", pa.binary())])


def covered_strings(ids: np.ndarray, pieces: list[bytes], size: int) -> np.ndarray:
    """For each place of the joined pieces (each followed by one separator): starts there a string that is covered?

    Sorts all suffixes, and among those of at least ``size`` bytes compares adjacent prefixes.
    """
    lengths = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    raw = np.zeros(int(lengths.sum()) + len(pieces) + 8, np.uint8)
    body = np.ones(len(raw) - 8, bool)
    body[ends] = False
    raw[:-8][body] = np.frombuffer(b"".join(pieces), np.uint8)
    text = raw[:-8].astype(np.int64)
    text += 2
    text[ends] = 1
    owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths + 1)
    order = suffix_array(text, 258)
    order = order[order + size <= ends[owner[order]]]
    out = np.zeros(len(text), bool)
    del text, body
    words = np.lib.stride_tricks.sliding_window_view(raw, 8).copy().view("<u8").ravel()
    same = np.ones(max(len(order) - 1, 0), bool)
    for at in sorted({*range(0, size - 8, 8), size - 8}):
        prefix = words[order + at]
        same &= prefix[1:] == prefix[:-1]
    run = np.concatenate([[0], np.cumsum(~same)])
    heads = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else np.zeros(0, int)
    doc = ids[owner[order]]
    least = np.minimum.reduceat(doc, heads)[run] if len(order) else doc
    out[order] = doc > least
    return out


def covered_runs(ids: np.ndarray, pieces: list[bytes], size: int, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Piece, first place and number of covered strings that start one after the other; ``gram`` is that of the anchors by
    which the pieces came together.

    Pieces of more than GROUP bytes get anchors from longer grams: equal strings have equal ones at equal places, so contexts
    of different anchors need not be compared. With grams as long as a string, contexts are strings and none is left.
    """
    lengths = np.array([len(p) for p in pieces], np.int64)
    if lengths.sum() <= GROUP or gram >= size:
        places = np.flatnonzero(covered_strings(ids, pieces, size))
        offset = np.cumsum(lengths + 1) - lengths - 1
        owner = np.searchsorted(offset, places, side="right") - 1
        yield owner, places - offset[owner], np.ones(len(places), np.int64)
        return
    gram = (gram + size + 1) // 2
    found, first = [], 0
    slices = (np.cumsum(lengths) - lengths) // GROUP
    for end in [*(np.flatnonzero(slices[1:] != slices[:-1]) + 1).tolist(), len(pieces)]:
        own = lengths[first:end]
        ends = np.cumsum(own)
        row, *rest = anchored(np.frombuffer(b"".join(pieces[first:end]), np.uint8), ends - own, ends, size, gram)
        found.append((row + first, *rest))
        first = end
    row, start, strings, anchor, context = (np.concatenate(x) for x in zip(*found))
    del found
    order = np.lexsort((ids[row], context, anchor))
    row, start, strings, anchor, context = (x[order] for x in (row, start, strings, anchor, context))
    covered, compare, _ = _settled(ids[row], anchor, context)
    yield row[covered], start[covered], strings[covered]
    row, start, strings, anchor = (x[compare] for x in (row, start, strings, anchor))
    bounds = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1], [True]])) if len(row) else np.zeros(1, int)
    run = np.concatenate([[0], np.cumsum(strings - 1 + size)])[bounds[:-1]] // (GROUP // 2)  # of anchors
    cuts = bounds[:-1][np.concatenate([[True], run[1:] != run[:-1]])] if len(row) else bounds[:0]
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(row)]):
        parts = [pieces[r][s : s + n - 1 + size] for r, s, n in zip(row[a:b].tolist(), start[a:b].tolist(), strings[a:b].tolist())]
        for piece, place, n in covered_runs(ids[row[a:b]], parts, size, gram):
            yield row[a:b][piece], start[a:b][piece] + place, n


def compared(size: int):
    """Suffix sort of one group's contexts: the covered strings of each document."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, keys = table.column("id").to_numpy(), table.column("key").to_numpy()
        starts = table.column("start").to_numpy().astype(np.int64)
        found = list(covered_runs(ids, table.column("bytes").to_pylist(), size))
        owner, place, strings = (np.concatenate(x) for x in zip(*found))
        return _covers(ids[owner], keys[owner], starts[owner] + place, strings, size)

    return run


def _covers(ids: np.ndarray, keys: np.ndarray, start: np.ndarray, strings: np.ndarray, size: int) -> pa.Table:
    """One row for each document, with runs of consecutive string starts joined."""
    if not len(ids):
        return COVER.empty_table()
    order = np.lexsort((start, keys, ids))
    ids, keys, start, strings = (x[order] for x in (ids, keys, start, strings))
    bounds = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]), [True]]))
    heads = bounds[:-1]
    return pa.table({
        "id": ids[heads], "key": keys[heads], "start": _cells(start.astype("<u4"), bounds),
        "strings": _cells(strings.astype(_count_type(size)), bounds),
    }, schema=COVER)


def single_strings(size: int):
    """The strings of crowded contexts, one row each, with a 128-bit hash."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("digest", pa.binary())])

    def given(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, key, at, raw in zip(*(batch.column(n).to_pylist() for n in ("id", "key", "start", "bytes"))):
                out += [
                    (doc, key, at + i, hashlib.blake2b(raw[i : i + size], digest_size=16).digest())
                    for i in range(len(raw) - size + 1)
                ]
                if len(out) >= ROWS:
                    yield given(out)
                    out = []
            yield given(out)

    return run


def as_cover(size: int):
    """Single covered strings as covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
            start = batch.column("start").to_numpy().astype(np.int64)
            yield from _covers(ids, keys, start, np.ones(len(ids), np.int64), size).to_batches()

    return run


def identified(docs: DataFrame, *more: Column | str) -> DataFrame:
    """``id`` (nulls last), ``key`` (a 64-bit hash that tells rows with one id apart), ``text`` and other columns."""
    doc_id = F.col("doc_id").cast("long")
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(doc_id, F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"), *more
    )


def covers(spread: DataFrame, size: int = SIZE, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``id, key, start, strings`` arrays of covered strings, gathered by document, of ``identified`` rows."""
    bounded_batches(spread.sparkSession)
    parts = max(32, spread.rdd.getNumPartitions())
    made = spread.select("id", "key", "text").mapInArrow(tidy(anchors(parts, size, gram)), PARTS_DDL)
    answered = written(made.repartition(parts, "part").groupBy("part").applyInArrow(replies(crowd, size), REPLY_DDL), "repeats")
    asked = answered.where(~F.col("covered")).groupBy("id", "key").agg(
        F.collect_list(F.struct("part", "crowd", "start", "strings")).alias("asked")
    )
    found = spread.select("id", "key", "text").join(asked, ["id", "key"]).mapInArrow(tidy(contexts(size)), CONTEXT_DDL)
    found = written(found, "repeat-contexts")

    plain = found.where(~F.col("crowd"))
    arrays = plain.repartition(ARRAYS * parts // 4, "part").groupBy("part").applyInArrow(compared(size), COVER_DDL)
    singles = found.where("crowd").mapInArrow(single_strings(size), "id long, key long, start int, digest binary")
    first = singles.groupBy("digest").agg(F.min("id").alias("first"))
    late = singles.join(first, "digest").where(F.col("id") > F.col("first")).select("id", "key", "start")
    crowded = late.mapInArrow(as_cover(size), COVER_DDL)
    settled = answered.where("covered").select("id", "key", "start", "strings")
    everything = settled.unionByName(arrays).unionByName(crowded)
    return everything.groupBy("id", "key").agg(F.collect_list(F.struct("start", "strings")).alias("found"))


def cut(raw: bytes, found: list | None, size: int) -> tuple[bytes, int, int]:
    """The bytes that remain, and the numbers of removed bytes and of maximal removed runs."""
    if found is None or not len(found):
        return raw, 0, 0
    start = np.concatenate([np.frombuffer(f["start"], "<u4") for f in found]).astype(np.int64)
    strings = np.concatenate([np.frombuffer(f["strings"], _count_type(size)) for f in found]).astype(np.int64)
    edge = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + strings - 1 + size, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def deduplicated(docs: DataFrame, size: int = SIZE, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``kept``, the remaining bytes, of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, found, raw in zip(batch.column("doc_id").to_pylist(), batch.column("found").to_pylist(), raw_texts(batch)):
                kept, removed, spans = cut(raw, found, size)
                out.append((doc, len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    spread = identified(docs, F.col("doc_id").cast("long").alias("doc_id"))
    joined = spread.join(covers(spread, size, crowd=crowd), ["id", "key"], "left").select("doc_id", "text", "found")
    return joined.mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def kept_documents(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """All rows of ``docs`` with repeated strings cut from ``text``, and ``n_chars``, where there is one, counted anew.

    A character of which a byte is cut goes whole. A null text stays null.
    """
    names = docs.columns

    @F.pandas_udf("string")
    def shortened(texts, found):
        return texts.combine(found, lambda t, f: t if t is None else cut(t.encode(), f, size)[0].decode(errors="ignore"))

    row = F.struct(*[F.col(f"`{n}`") for n in names]).alias("row")
    spread = identified(docs, row)
    joined = spread.join(covers(spread, size), ["id", "key"], "left")
    kept = joined.select("row", F.when(F.col("found").isNull(), F.col("text")).otherwise(shortened("text", "found")).alias("kept"))
    fresh = {"text": F.col("kept").cast(docs.schema["text"].dataType)}
    if "n_chars" in names:
        fresh["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return kept.select(*[fresh.get(n, F.col("row")[n]).alias(n) for n in names])
