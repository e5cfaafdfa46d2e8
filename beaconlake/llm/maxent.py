"""A hashed maximum-entropy language model with a class-factored softmax.

The next token's class, then the token in its class, are log-linear in hashed features of the words before: the word
before and the pair of the last two (n-grams), and the word before the last (skip). The most frequent words have classes of
their own of WIDTH words each; the other words are spread over TAIL classes by their endings, and share their class's
probability by their counts in all training documents, with half a count for each and for what is unknown. So the
probabilities of all tokens sum to one.

Training is distributed: in each round every task runs gradient steps over its own training documents from the shared
weights, and sends its weights with how often each row was touched; the next shared weights are the touch-weighted means.
Every training document is used in one round. Scoring works on numpy batches of whole documents.

Counts of all words are a table. The most frequent LOOKUP words go to all tasks; rarer words meet their counts by a join.

Defined cases: a null text counts as empty and is the end token alone. Without training documents all counts are 0.
Repeated rows and null doc_ids give one row each; a null doc_id is held out by the crc32 of the empty text.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.llm.common import fold_of, raw_texts, texts
from beaconlake.session import written

FOLDS, HELD_OUT = 5, 1
#: Head classes, words in each, classes of rarer words, and endings that stand for rarer words in contexts.
HEADS, WIDTH, TAILS, ENDINGS = 16, 32, 16, 1024
#: Rows of the pair feature and of the in-class weights.
PAIRS, INNER = 8192, 16384
LOOKUP = 131_072
ROUNDS, RATE, BATCH = 2, 0.35, 4096
#: Bytes of text whose words are numbered together.
SLICE = 1 << 20
#: Largest size of a feature's weight: with three of them and a bias, exponentials stay within single precision.
LARGEST = 15.0
#: Words held by a counting task before it sends them on, rows of a block of weights.
HELD_WORDS, BLOCK = 300_000, 256

HEAD_WORDS = HEADS * WIDTH
CONTEXTS = HEAD_WORDS + ENDINGS
CLASSES = HEADS + TAILS
OUTER_ROWS = 2 * CONTEXTS + PAIRS
#: The end token; white space cannot be part of a word.
END = b"\n"


@dataclass
class Coded:
    """Tokens of a run of documents: distinct words, the last of them END, and each token's place among them."""

    dictionary: pa.LargeBinaryArray
    index: np.ndarray
    starts: np.ndarray

    @property
    def words(self) -> list[bytes]:
        return self.dictionary.to_numpy(zero_copy_only=False).tolist()


def coded_tokens(raws: list[bytes]) -> Coded:
    """Words of lower-cased texts, split and numbered by Arrow; an end token closes each text."""
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    joined = b"".join(raws).lower()
    whole = pa.LargeStringArray.from_buffers(len(raws), pa.py_buffer(offsets), pa.py_buffer(joined))
    split = pc.ascii_split_whitespace(whole)
    found = split.flatten()
    real = pc.greater(pc.binary_length(found), 0)  # white space at the ends of a text leaves empty words
    owner = np.repeat(np.arange(len(raws)), split.value_lengths().to_numpy(zero_copy_only=False))
    sizes = np.bincount(owner, real.to_numpy(zero_copy_only=False), len(raws)).astype(np.int64) + 1
    coded = found.filter(real).dictionary_encode()
    ends = np.cumsum(sizes)
    index = np.full(int(ends[-1]), len(coded.dictionary), np.int64)
    inside = np.ones(len(index), bool)
    inside[ends - 1] = False
    index[inside] = coded.indices.to_numpy()
    dictionary = pa.concat_arrays([coded.dictionary.cast(pa.large_binary()), pa.array([END], pa.large_binary())])
    return Coded(dictionary, index, ends - sizes)


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


#: zlib's table, read off the sums of single bytes.
_CRC = np.array([zlib.crc32(bytes([b ^ 255])) ^ 0xFF000000 for b in range(256)], np.uint32)


def crc_of_last(words: pa.LargeBinaryArray, most: int) -> np.ndarray:
    """zlib.crc32 of the last ``most`` bytes of each word, or of the whole of a shorter one."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    register = np.full(len(words), 0xFFFFFFFF, np.uint32)
    for back in range(most, 0, -1):
        own = np.flatnonzero(np.diff(offsets) >= back)
        held = register[own]
        register[own] = _CRC[(held ^ raw[offsets[own + 1] - back]) & np.uint32(255)] ^ (held >> np.uint32(8))
    return (register ^ np.uint32(0xFFFFFFFF)).astype(np.int64)


def is_training(doc_id: int | None) -> bool:
    return fold_of(doc_id, FOLDS) != HELD_OUT


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over the training documents; tasks add up before the shuffle."""
    names = ["word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def added() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(names)

        for batch in batches:
            for _, found in _documents(batch, [is_training(i) for i in batch.column("doc_id").to_pylist()]):
                n = np.bincount(found.index, minlength=len(found.dictionary))
                held.append(pa.table([found.dictionary.cast(pa.binary()), pa.array(n, pa.int64())], names=names))
                if sum(map(len, held)) > 2 * HELD_WORDS:
                    held = [added()]
                    if len(held[0]) > HELD_WORDS:
                        yield from held.pop().to_batches()
        if held:
            yield from added().to_batches()

    return texts(docs).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Places:
    """Places of words in a list, looked up by Arrow; -1 for others."""

    def __init__(self, words: list[bytes]):
        self.words = pa.array(words, pa.large_binary())

    def of(self, words: pa.LargeBinaryArray) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()


@dataclass
class Vocabulary:
    """``count`` of the most frequent words, places of the head words, and totals of all tokens and of the tail classes."""

    count: dict[bytes, int]
    head: dict[bytes, int]
    total: int
    distinct: int
    tail_total: np.ndarray
    tail_distinct: np.ndarray


def least_count(counts: DataFrame, most: int, cells: int = 64) -> int:
    """The smallest count that at most ``most`` words reach, from histograms of ``cells`` cells that close in on it.

    A sort with a limit would send as many rows from every partition; a histogram sends its cells.
    """
    low, high = 1, (counts.agg(F.max("n")).first()[0] or 0) + 1
    above = 0  # words that reach ``high``
    while low < high:
        step = -(-(high - low) // cells)
        cell = F.floor((F.col("n") - low) / step)
        rows = counts.where((F.col("n") >= low) & (F.col("n") < high)).groupBy(cell.alias("cell")).count().collect()
        for at, words in sorted(((r["cell"], r["count"]) for r in rows), reverse=True):
            if above + words > most:
                break
            above += words
            high = low + at * step
        else:
            return low
        # the words of cell ``at`` are too many as a whole
        if step == 1:
            return low + at + 1
        low, high = low + at * step, min(high, low + (at + 1) * step)
    return high


def vocabulary(counts: DataFrame) -> Vocabulary:
    """At most LOOKUP words and TAILS totals reach the driver."""
    top = counts.where(F.col("n") >= least_count(counts, LOOKUP)).collect()
    top = sorted(top, key=lambda r: (-r["n"], r["word"]))
    ranked = [bytes(r["word"]) for r in top]
    chosen = [END, *[w for w in ranked if w != END][: HEAD_WORDS - 1]]
    head = {word: i for i, word in enumerate(chosen)}
    places = Places(list(head))

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(TAILS + 1, np.int64), np.zeros(TAILS + 1, np.int64)
        for batch in batches:
            own = batch.column("word").cast(pa.large_binary())
            found = np.where(places.of(own) < 0, crc_of_last(own, 2) % TAILS, TAILS)
            n = batch.column("n").to_numpy()
            total += np.bincount(found, n, TAILS + 1).astype(np.int64)
            kinds += np.bincount(found, minlength=TAILS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAILS + 1)), pa.array(total), pa.array(kinds)], names=["tail", "n", "kinds"])

    sums = counts.mapInArrow(tails, "tail long, n long, kinds long").groupBy("tail").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds"))
    total, kinds = np.zeros(TAILS + 1, np.int64), np.zeros(TAILS + 1, np.int64)
    for row in sums.collect():
        total[row["tail"]], kinds[row["tail"]] = row["n"], row["kinds"]
    count = {bytes(r["word"]): r["n"] for r in top}
    return Vocabulary(count, head, int(total.sum()), int(kinds.sum()), total[:TAILS], kinds[:TAILS])


class Codes:
    """For each word one number: context (any bits above 11), class (6 bits), place in its class (5 bits)."""

    def __init__(self, head: dict[bytes, int]):
        self.places = Places(list(head))
        at = np.array([*head.values()], np.int64)
        self.codes = np.append(at << 11 | (at // WIDTH) << 5 | at % WIDTH, 0)

    def of(self, found: Coded) -> np.ndarray:
        """Codes of all tokens, from those of the distinct words: ``ending`` and ``tail_class`` of all words at once."""
        at, words = self.places.of(found.dictionary), found.dictionary
        tail = (HEAD_WORDS + crc_of_last(words, 3) % ENDINGS) << 11 | (HEADS + crc_of_last(words, 2) % TAILS) << 5
        return np.where(at < 0, tail, self.codes[at])[found.index]


@dataclass
class Weights:
    outer: np.ndarray  # OUTER_ROWS + 1 rows of CLASSES; the last is the bias
    inner: np.ndarray  # INNER + HEADS rows of WIDTH; the last HEADS are the classes' biases


def initial(v: Vocabulary) -> Weights:
    """Unigram shares as biases, all else zero."""
    outer = np.zeros((OUTER_ROWS + 1, CLASSES), np.float32)
    inner = np.zeros((INNER + HEADS, WIDTH), np.float32)
    shares = np.full(HEAD_WORDS, 0.5)
    for word, at in v.head.items():
        shares[at] += v.count.get(word, 0)
    shares = shares.reshape(HEADS, WIDTH)
    classes = np.concatenate([shares.sum(1), v.tail_total + 0.5 * (v.tail_distinct + 1)])
    outer[-1] = np.log(classes / classes.sum())
    inner[INNER:] = np.log(shares / shares.sum(1, keepdims=True))
    return Weights(outer, inner)


def feature_rows(context: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of the outer weights for every token: last word, skip, last pair. Before a text stand end tokens."""
    n = len(context)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    before = []
    for k in (1, 2):
        shifted = np.zeros(n, np.int64)
        shifted[k:] = context[: n - k]
        before.append(np.where(place >= k, shifted, 0))
    pair = (before[0] * 40503 + before[1] * 30011 + 7) % 1_000_003 % PAIRS
    return np.stack([before[0], CONTEXTS + before[1], 2 * CONTEXTS + pair])


def inner_rows(rows: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Rows of the in-class weights: last word and skip, each with the class."""
    return ((rows[:2] * 64 + kind) * 48271 + 11) % 2_147_483_647 % INNER


def shares(found: np.ndarray) -> np.ndarray:
    """Softmax of each row, in place. Weights are held within a range where no exponential overflows."""
    np.exp(found, out=found)
    found *= np.float32(1) / (found @ np.ones((found.shape[1], 1), np.float32))
    return found


def outer_shares(w: Weights, rows: np.ndarray) -> np.ndarray:
    found = w.outer.take(rows[0], axis=0)
    for r in rows[1:]:
        found += w.outer.take(r, axis=0)
    found += w.outer[-1]
    return shares(found)


def inner_shares(w: Weights, rows: np.ndarray, kind: np.ndarray) -> np.ndarray:
    found = w.inner.take(INNER + kind, axis=0)
    for r in rows:
        found += w.inner.take(r, axis=0)
    return shares(found)


def unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return codes >> 11, codes >> 5 & 63, codes & 31


class Trainer:
    """Gradient steps with one learning rate for each row, falling with the squared gradients it has seen."""

    def __init__(self, weights: Weights):
        self.w = Weights(weights.outer.copy(), weights.inner.copy())
        self.seen = [np.full(len(t), 1e-2, np.float32) for t in (self.w.outer, self.w.inner)]
        self.touched = [np.zeros(len(t), np.int64) for t in (self.w.outer, self.w.inner)]

    def _descend(self, which: int, table: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
        order = np.argsort(rows.astype(np.uint16), kind="stable")
        ordered = rows[order]
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        own, times = ordered[heads], np.diff(np.append(heads, len(rows)))
        total = np.add.reduceat(slope.take(order, axis=0), heads, axis=0)
        seen = self.seen[which]
        seen[own] += np.einsum("ij,ij->i", total, total) / total.shape[1]
        table[own] = np.clip(table[own] - total * (RATE / np.sqrt(seen[own]))[:, None], -LARGEST, LARGEST)
        self.touched[which][own] += times

    def step(self, rows: np.ndarray, kind: np.ndarray, place: np.ndarray) -> None:
        slope = outer_shares(self.w, rows)
        slope[np.arange(len(kind)), kind] -= 1
        for r in rows:
            self._descend(0, self.w.outer, r, slope)
        own = np.flatnonzero(kind < HEADS)
        if len(own):
            kind, place, chosen = kind[own], place[own], inner_rows(rows[:, own], kind[own])
            slope = inner_shares(self.w, chosen, kind)
            slope[np.arange(len(kind)), place] -= 1
            for r in chosen:
                self._descend(1, self.w.inner, r, slope)


def _documents(batch: pa.RecordBatch, chosen: list[bool] | None = None) -> Iterator[tuple[list[int], Coded]]:
    """Runs of documents with about SLICE bytes: their rows and tokens."""
    rows, held, total = [], [], 0
    for i, raw in enumerate(raw_texts(batch)):
        if chosen is None or chosen[i]:
            rows.append(i)
            held.append(raw)
            total += len(raw)
            if total >= SLICE:
                yield rows, coded_tokens(held)
                rows, held, total = [], [], 0
    if rows:
        yield rows, coded_tokens(held)


TRAINED = pa.schema([("table", pa.int32()), ("block", pa.int32()), ("touched", pa.binary()), ("weights", pa.binary())])
TRAINED_DDL = "table int, block int, touched binary, weights binary"


def trained(docs: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Weights after all rounds; the driver holds one model, whose size is fixed."""
    context = docs.sparkSession.sparkContext
    held_head = context.broadcast(v.head)
    weights = initial(v)
    for turn in range(rounds):
        held = context.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], held=held, turn=turn) -> Iterator[pa.RecordBatch]:
            trainer, codes = Trainer(held.value), Codes(held_head.value)
            for batch in batches:
                folds = [fold_of(i, FOLDS * rounds) for i in batch.column("doc_id").to_pylist()]
                mine = [is_training(i) and f // FOLDS == turn for i, f in zip(batch.column("doc_id").to_pylist(), folds)]
                for _, found in _documents(batch, mine):
                    word, kind, place = unpacked(codes.of(found))
                    rows = feature_rows(word, found.starts)
                    for at in range(0, len(word), BATCH):
                        cut = slice(at, at + BATCH)
                        trainer.step(rows[:, cut], kind[cut], place[cut])
            out = []
            for number, table in enumerate((trainer.w.outer, trainer.w.inner)):
                touched = trainer.touched[number]
                for at in range(0, len(table) - (1 if number == 0 else HEADS), BLOCK):
                    if touched[at : at + BLOCK].any():
                        out.append({
                            "table": number, "block": at // BLOCK, "touched": touched[at : at + BLOCK].tobytes(),
                            "weights": table[at : at + BLOCK].tobytes(),
                        })
            yield pa.RecordBatch.from_pylist(out, schema=TRAINED)

        def mean(key: tuple, table: pa.Table) -> pa.Table:
            total, times = 0.0, 0
            for touched, block in zip(table.column("touched"), table.column("weights")):
                n = np.frombuffer(touched.as_py(), np.int64)
                total = total + np.frombuffer(block.as_py(), np.float32).reshape(len(n), -1).astype(np.float64) * n[:, None]
                times = times + n
            shared = (total / np.maximum(times, 1)[:, None]).astype(np.float32)
            return pa.Table.from_pylist([{
                "table": key[0].as_py(), "block": key[1].as_py(), "touched": times.tobytes(), "weights": shared.tobytes(),
            }], schema=TRAINED)

        means = texts(docs).mapInArrow(run, TRAINED_DDL).groupBy("table", "block").applyInArrow(mean, TRAINED_DDL)
        weights = Weights(weights.outer.copy(), weights.inner.copy())
        for row in means.collect():
            table = weights.inner if row["table"] else weights.outer
            n = np.frombuffer(row["touched"], np.int64)
            at = row["block"] * BLOCK + np.flatnonzero(n)
            table[at] = np.frombuffer(row["weights"], np.float32).reshape(len(n), -1)[n > 0]
    return weights


def token_scores(w: Weights, v: Vocabulary, coded: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Natural log probability of each token; of a tail word without its own half-smoothed count."""
    word, kind, place = unpacked(coded)
    rows = feature_rows(word, starts)
    share = np.concatenate([np.zeros(HEADS), np.log(v.tail_total + 0.5 * (v.tail_distinct + 1))])
    out = np.empty(len(coded))
    for at in range(0, len(coded), BATCH):
        cut = slice(at, at + BATCH)
        k = kind[cut]
        found = np.log(outer_shares(w, rows[:, cut])[np.arange(len(k)), k].astype(np.float64)) - share[k]
        own = np.flatnonzero(k < HEADS)
        if len(own):
            chosen = inner_rows(rows[:, cut][:, own], k[own])
            found[own] += np.log(inner_shares(w, chosen, k[own])[np.arange(len(own)), place[cut][own]].astype(np.float64))
        out[cut] = found
    return out


PART_DDL = (
    "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "rare array<struct<word: binary, times: int>>"
)
PART = pa.schema([
    ("uid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base", pa.float64()), ("score", pa.float64()),
    ("rare", pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))),
])


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text."""
    context = docs.sparkSession.sparkContext
    counts = written(word_counts(docs), "word-counts")
    v = vocabulary(counts)
    held = context.broadcast((v, trained(docs, v)))
    floor = math.log10(v.total + 0.5 * (v.distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v, weights = held.value
        codes, uid = Codes(v.head), TaskContext.get().partitionId() << 33
        known, logs_of = Places(list(v.count)), np.array([*(math.log10(n + 0.5) for n in v.count.values()), np.nan])
        for batch in batches:
            ids = batch.column("doc_id")
            for rows, found in _documents(batch):
                coded, starts = codes.of(found), found.starts
                base = logs_of[known.of(found.dictionary)][found.index]
                here = ~np.isnan(base)
                tails = coded >> 5 & 63 >= HEADS
                sizes = np.diff(np.append(starts, len(coded)))
                logs = token_scores(weights, v, coded, starts) / math.log(10) + np.where(tails & here, base, 0)
                # rarer words of each document, each with its number
                owner = np.repeat(np.arange(len(rows)), sizes)[~here]
                pairs, times = np.unique(owner * len(found.dictionary) + found.index[~here], return_counts=True)
                owner, word = np.divmod(pairs, len(found.dictionary))
                rare = pa.StructArray.from_arrays(
                    [found.dictionary.take(pa.array(word)).cast(pa.binary()), pa.array(times.astype(np.int32))], names=["word", "times"]
                )
                mine = ids.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([
                    pa.array(uid + np.arange(len(rows))), mine, pa.array([not is_training(i) for i in mine.to_pylist()]), pa.array(sizes),
                    pa.array(np.add.reduceat(here.astype(np.int64), starts)),
                    pa.array(np.add.reduceat(np.where(here, base, 0), starts) - sizes * floor), pa.array(np.add.reduceat(logs, starts)),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(rows) + 1)).astype(np.int32)), rare),
                ], schema=PART)
                uid += len(rows)

    parts = written(texts(docs).mapInArrow(run, PART_DDL), "scored")
    rare = parts.select("uid", F.explode("rare").alias("rare")).select("uid", "rare.word", "rare.times")
    met = rare.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = met.groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("late"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more"),
    )
    late, more = F.coalesce("late", F.lit(0.0)), F.coalesce("more", F.lit(0))
    joined = parts.drop("rare").join(sums, "uid", "left")
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + late).alias("base_score"), (F.col("score") + late).alias("score"),
    )
