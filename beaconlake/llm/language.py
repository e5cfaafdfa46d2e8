"""Language identification by prediction by partial matching.

For each language a tree of byte contexts, up to ORDER bytes long, is counted on a bounded sample of labelled documents.
With these statistics frozen, a byte costs -log2 of its share in the longest known context, where a context keeps one share
for each distinct byte it has seen to escape to the next shorter one; below the empty context all 256 bytes are equal. The
language with the shortest code for the whole text wins; the score is its posterior probability under equal priors.

The contexts of all languages form one tree of at most CELLS / (bytes * languages) contexts, the most frequent ones, so
the tables have a fixed size. A text's contexts are found by ORDER table look-ups for each byte.

Defined cases: a null text, and a text without a letter, is ``und`` with score 0. Documents with null lang or text teach
nothing; without any teacher every document is ``und``. Copies of a text teach once, and no language that has a text goes untaught. Repeated rows and null doc_ids give one row each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.llm.common import fold, fold_of, raw_texts, tidy
from beaconlake.session import written

ORDER = 3
#: Numbers in the cost table, bytes sampled for each language, bytes of the pieces that are drawn, and ranges of the hash
#: that orders a language's pieces.
CELLS = 1 << 22
SAMPLE_BYTES = 1_500_000
PIECE = 65_536
RANGES = 1024
SLICE = 1 << 20
#: Letters, and numerals that are no digits; only str.isalpha tells these apart.
LETTER = re.compile(r"[^\W\d_]")
ASCII_LETTER = re.compile(rb"[A-Za-z]")
UNKNOWN = "und"


@dataclass
class Contexts:
    """``symbol`` maps bytes to columns; ``child[node, symbol]`` is the context one byte longer, or the frozen node;
    ``cost[node * symbols + symbol]`` has the code lengths in all languages."""

    languages: list[str]
    symbol: np.ndarray
    child: np.ndarray
    cost: np.ndarray


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, each text led by ORDER zero bytes; where each text starts and ends."""
    gap = b"\x00" * ORDER
    joined = np.frombuffer(gap + gap.join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + ORDER)
    return joined, ends - sizes, ends


def train(samples: dict[str, list[bytes]]) -> Contexts:
    """Count contexts and their followers for each language, and turn them into tables of code lengths."""
    languages = sorted(samples)
    streams = {}
    for name in languages:
        joined, starts, ends = _padded(samples[name])
        text = np.zeros(len(joined) + 1, np.int32)
        np.add.at(text, starts, 1)
        np.add.at(text, ends, -1)
        streams[name] = (joined, np.cumsum(text[:-1]).astype(bool))
    seen = np.unique(np.concatenate([j[t] for j, t in streams.values()]))
    symbol = np.zeros(256, np.int64)  # column 0: bytes never seen, and the place before a text
    symbol[seen] = np.arange(1, len(seen) + 1)
    width = len(seen) + 1

    # packed context of k bytes (nearest first), and the same with its follower, at every byte of a text
    grams: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for name, (joined, inside) in streams.items():
        codes = symbol[joined]
        codes[~inside] = 0
        at = np.flatnonzero(inside)
        grams[name] = []
        context = np.zeros(len(at), np.int64)
        for k in range(ORDER + 1):
            if k:
                context = context * width + codes[at - k]
            grams[name].append(np.unique(context * width + codes[at], return_counts=True))

    nodes = [np.zeros(1, np.int64)]
    room = max(0, CELLS // (width * len(languages)) - 1)
    known = []
    for k in range(1, ORDER + 1):
        packed = np.concatenate([grams[n][k][0] // width for n in languages])
        times = np.concatenate([grams[n][k][1] for n in languages])
        unique, back = np.unique(packed, return_inverse=True)
        known.append((np.bincount(back, times), np.full(len(unique), k), unique))
    weight, depth, packed = (np.concatenate(x) for x in zip(*known))
    # a context is never more frequent than the shorter one it extends, so the most frequent ones form a tree
    best = np.sort(np.lexsort((packed, depth, -weight))[:room])
    for k in range(1, ORDER + 1):
        nodes.append(np.sort(packed[best][depth[best] == k]))

    first = np.concatenate([[0], np.cumsum([len(n) for n in nodes])])
    total = int(first[-1])
    child = np.empty((2 * total, width), np.int32)
    child[:] = np.arange(2 * total)[:, None]
    child[:total] += total  # without a longer context the node freezes: rows from ``total`` on lead to themselves
    for k in range(1, ORDER + 1):
        parent = first[k - 1] + np.searchsorted(nodes[k - 1], nodes[k] // width)
        child[parent, nodes[k] % width] = first[k] + np.arange(len(nodes[k]))

    cost = np.empty((total, width, len(languages)), np.float32)
    for j, name in enumerate(languages):
        own = np.full((total, width), 8.0)
        for k in range(ORDER + 1):
            packed, times = grams[name][k]
            place = np.searchsorted(nodes[k], packed // width)
            fits = place < len(nodes[k])
            fits[fits] = nodes[k][place[fits]] == packed[fits] // width
            place, follower, times = place[fits], packed[fits] % width, times[fits].astype(float)
            sums = np.bincount(place, times, len(nodes[k]))
            kinds = np.bincount(place, minlength=len(nodes[k])).astype(float)
            rows = slice(first[k], first[k + 1])
            # ``nodes`` are packed nearest byte first, so dropping the last digit gives the shorter context
            shorter = np.full((len(nodes[k]), width), 8.0) if k == 0 else own[first[k - 1] + np.searchsorted(nodes[k - 1], nodes[k] // width)]
            escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(sums + kinds, 1)), 0.0)
            own[rows] = shorter + escape[:, None]
            own[first[k] + place, follower] = -np.log2(times / (sums + kinds)[place])
        cost[:, :, j] = own
    return Contexts(languages, symbol.astype(np.int32), child, cost.reshape(-1, len(languages)))


def code_lengths(model: Contexts, batch: list[bytes]) -> np.ndarray:
    """Bits of each text in each language; every text starts from the empty context."""
    out = np.zeros((len(batch), len(model.languages)))
    width, total = model.child.shape[1], len(model.child) // 2
    flat = model.child.ravel()

    def measure(rows: list[int], parts: list[bytes], lead: bytes = b"") -> None:
        joined, starts, ends = _padded([lead + p for p in parts])
        codes = model.symbol[joined]
        for a, b in zip(starts, ends):
            codes[a - ORDER : a] = 0
        node = np.zeros(len(codes) - ORDER, np.int32)
        for k in range(1, ORDER + 1):
            node = flat[node * width + codes[ORDER - k : len(codes) - k]]
        node %= total
        bits = model.cost[node * width + codes[ORDER:]]
        bounds = np.column_stack([starts - ORDER + len(lead), ends - ORDER]).ravel()
        bits = np.concatenate([bits, np.zeros((1, bits.shape[1]), np.float32)])
        np.add.at(out, rows, np.add.reduceat(bits, bounds, axis=0, dtype=np.float64)[::2])

    held: list[int] = []
    size = 0
    for i, text in enumerate(batch):
        if len(text) > SLICE:  # a very long text goes in slices that share ORDER bytes
            for at in range(0, len(text), SLICE):
                measure([i], [text[at : at + SLICE]], text[max(0, at - ORDER) : at])
        elif text:
            held.append(i)
            size += len(text)
        if size > SLICE or (held and i + 1 == len(batch)):
            measure(held, [batch[j] for j in held])
            held, size = [], 0
    if held:
        measure(held, [batch[j] for j in held])
    return out


def has_letter(raw: bytes) -> bool:
    return bool(ASCII_LETTER.search(raw) or (not raw.isascii() and any(m[0].isalpha() for m in LETTER.finditer(raw.decode()))))


def predicted(model: Contexts | None, batch: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, score = [UNKNOWN] * len(batch), np.zeros(len(batch))
    rows = [i for i, raw in enumerate(batch) if model is not None and has_letter(raw)]
    if rows:
        bits = code_lengths(model, [batch[i] for i in rows])
        best = bits.argmin(1)
        shares = np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000))
        score[rows] = 1 / shares.sum(1)
        for i, j in zip(rows, best):
            names[i] = model.languages[j]
    return names, score


PIECE_KEYS = ["lang", "hash", "number"]


def drawn(pieces: DataFrame) -> DataFrame:
    """``PIECE_KEYS`` of the distinct pieces that teach: in hash order, as many of a language as begin before SAMPLE_BYTES.

    A running sum over ranges of the hash leaves few pieces for the one over pieces.
    """
    once = pieces.groupBy(*PIECE_KEYS).agg(F.max(F.octet_length("piece")).alias("size"))
    once = once.withColumn("place", F.xxhash64("hash", "number", F.lit(1)))
    once = written(once.withColumn("range", F.shiftright("place", 65 - RANGES.bit_length())), "teachers")
    sums = once.groupBy("lang", "range").agg(F.sum("size").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("lang").orderBy("range")) - F.col("sum")
    first = sums.withColumn("before", before).where(F.col("before") < SAMPLE_BYTES)
    near = once.join(first.select("lang", "range"), ["lang", "range"])
    running = Window.partitionBy("lang").orderBy("place", "hash", "number").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("size").over(running) - F.col("size")
    return near.withColumn("before", before).where(F.col("before") < SAMPLE_BYTES).select(*PIECE_KEYS)


def fit(docs: DataFrame) -> Contexts | None:
    """Train on documents outside the held-out fold: for each language pieces of distinct texts, drawn from whole texts by hash."""
    teachers = docs.where((fold(5) != 0) & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    raw, last = F.col("text").cast("binary"), F.floor((F.octet_length("text") - 1) / PIECE).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("number"), F.substring(raw, i * PIECE + 1, F.lit(PIECE)).alias("piece"))
    )
    pieces = teachers.select(F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("hash"), F.inline(parts))
    chosen = written(drawn(pieces), "teachers-drawn")
    # copies are one again before they leave their tasks
    once = pieces.join(chosen, PIECE_KEYS).groupBy(*PIECE_KEYS).agg(F.first("piece").alias("piece"))
    samples: dict[str, list[list[bytes]]] = {}
    before = None
    for lang, key, number, piece in sorted((r["lang"], r["hash"], r["number"], bytes(r["piece"])) for r in once.collect()):
        found = samples.setdefault(lang, [])
        if before == (lang, key, number - 1):
            found[-1].append(piece)  # neighbours are one text
        else:
            found.append([piece])
        before = lang, key, number
    return train({name: sorted(b"".join(t) for t in found) for name, found in samples.items()}) if samples else None


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every whole text; no shuffle."""
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang")
    held = docs.sparkSession.sparkContext.broadcast(fit(typed))  # at most CELLS numbers and as many links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = predicted(held.value, list(raw_texts(batch)))
            folds = [fold_of(i, 5) == 0 for i in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(folds), pa.array(names), pa.array(score)], schema=OUT
            )

    return typed.drop("lang").mapInArrow(tidy(run), "doc_id long, held_out boolean, lang_pred string, score double")


def kept_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with at least ``least``, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(
        fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = predicted(held.value, list(raw_texts(batch)))
            yield batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, score)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
