"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs their votes.

Each rule says good, bad or nothing of a document. How often a rule is right on good and on bad documents, and how many
documents are good, is estimated from the votes of all documents alone: the counts of vote patterns are sufficient, and
there are at most three to the number of rules of them. A document is kept when the posterior probability of good reaches
one half and it passes the two base limits.

Defined cases: a null or empty text has no words, fails the base limits and is not kept. Repeated rows and null doc_ids
give one row each. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.llm.common import raw_texts, texts, tidy, words
from beaconlake.session import written

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
#: Bytes that open no code point of a word: UTF-8 continuations and ASCII white space.
NOT_COUNTED = bytes([*range(0x80, 0xC0), 0x20, *range(0x09, 0x0E)])
UPPER = bytes(range(0x41, 0x5B))
MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalpha())
DIGITS = b"0123456789"
#: Words that are one mark alone, as between the entries of menus and tables.
BARE = frozenset(bytes([b]) for b in MARKS if not chr(b).isdigit())

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_marks", "n_digits", "n_bare",
)


def repeated_words(found: list[bytes]) -> int:
    """Words covered by five-word windows that occur at least twice in the text."""
    if len(found) <= WINDOW:
        return 0
    windows = list(zip(*(found[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = bytearray(len(found))
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered[i : i + WINDOW] = b"\x01" * WINDOW
    return sum(covered)


def features(raw: bytes) -> tuple[int, ...]:
    found = words(raw)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    size = len(raw)
    return (
        len(found),
        len(raw.translate(None, NOT_COUNTED)),
        size - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(found),
        len(lines),
        len(set(found)),
        size - len(raw.translate(None, UPPER)),
        size - len(raw.translate(None, MARKS)),
        size - len(raw.translate(None, DIGITS)),
        sum([word in BARE for word in found]),
    )


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """-1 where bad, else 1 where good, else 0."""
    return np.where(bad, -1, np.where(good, 1, 0))


def votes(table: np.ndarray) -> np.ndarray:
    """One column of votes for each rule, from rows of FEATURES."""
    f = dict(zip(FEATURES, table.T.astype(float)))
    n = np.maximum(f["n_words"], 1)
    chars = np.maximum(f["word_chars"], 1)
    mean = f["word_chars"] / n
    symbols, marks, upper = f["n_symbols"] / n, f["n_marks"] / chars, f["n_upper"] / chars
    copied, repeated = f["n_dup_lines"] / np.maximum(f["n_lines"], 1), f["n_repeat_words"] / n
    spread, digits, bare = f["n_distinct"] / n, f["n_digits"] / chars, f["n_bare"] / n
    long = f["n_words"] >= 50
    return np.column_stack([
        _vote(f["n_words"] < 10, f["n_words"] >= 30),
        _vote((mean < 2.5) | (mean > 14), (mean >= 3) & (mean <= 10)),
        _vote(symbols > 0.1, symbols <= 0.02),
        _vote(marks > 0.2, marks <= 0.08),
        _vote(upper > 0.3, upper <= 0.1),
        _vote(copied > 0.3, (copied <= 0.1) & (f["n_lines"] >= 3)),
        _vote(repeated > 0.2, (repeated <= 0.05) & long),
        _vote(long & (spread < 0.25) & (f["n_words"] < 1000), long & (spread > 0.45)),
        _vote(digits > 0.2, digits <= 0.05),
        _vote(bare > 0.15, bare <= 0.03),
    ])


RULES = 10


def coded(ballots: np.ndarray) -> np.ndarray:
    """One number for each vote pattern."""
    return (ballots + 1) @ 3 ** np.arange(RULES)


def decoded(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(RULES) % 3 - 1


def estimate(patterns: np.ndarray, times: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents, and each rule's accuracy on (bad, good) documents among its votes, by EM.

    Rules are taken as independent given the class. A rule may miss most bad documents, as each looks for one fault, but it
    must call bad ones bad more often than good ones; ``prior`` votes keep a rule that hardly ever votes near its start.
    """
    ballots, start, prior = decoded(patterns), (0.3, 0.97), 10.0
    share, right = 0.8, np.repeat([start], RULES, axis=0).T
    for _ in range(rounds):
        good = posterior(ballots, share, right)
        new = np.empty_like(right)
        for label, weight in ((0, times * (1 - good)), (1, times * good)):
            agree = weight @ (ballots == 2 * label - 1)
            new[label] = (agree + start[label] * prior) / (weight @ (ballots != 0) + prior)
        new[1] = np.clip(new[1], 0.9, 0.999)
        new[0] = np.clip(new[0], 1.05 - new[1], 0.99)
        new_share = float(np.clip((times @ good + 8) / (times.sum() + 10), 0.05, 0.95))
        done = abs(new_share - share) + np.abs(new - right).max() < 1e-9
        share, right = new_share, new
        if done:
            break
    return share, right


def log_odds(right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a good and a bad vote of each rule add to the log odds of good."""
    return np.log(right[1]) - np.log(1 - right[0]), np.log(1 - right[1]) - np.log(right[0])


def posterior(ballots: np.ndarray, share: float, right: np.ndarray) -> np.ndarray:
    for_good, for_bad = log_odds(right)
    odds = np.log(share / (1 - share)) + (ballots == 1) @ for_good + (ballots == -1) @ for_bad
    return 1 / (1 + np.exp(-odds))


def base_failed(table: np.ndarray) -> np.ndarray:
    n, repeated = table[:, 0], table[:, FEATURES.index("n_repeat_words")]
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)


def _table(batch: pa.RecordBatch) -> np.ndarray:
    rows = [features(raw) for raw in raw_texts(batch)]
    return np.array(rows, np.int64).reshape(-1, len(FEATURES))


SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in FEATURES) + ", base_failed boolean, pattern long"


def measured(docs: DataFrame) -> DataFrame:
    """Features, base verdict and vote pattern of every document; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = _table(batch)
            columns = [pa.array(table[:, i]) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(base_failed(table)), pa.array(coded(votes(table)))],
                names=["doc_id", *FEATURES, "base_failed", "pattern"],
            )

    return texts(docs).mapInArrow(tidy(run), SCHEMA)


def learned(found: DataFrame) -> tuple[float, np.ndarray]:
    """EM over the pattern counts of all documents (at most 3**RULES rows reach the driver)."""
    rows = found.groupBy("pattern").agg(F.count("*").alias("n")).collect()
    rows.sort()
    return estimate(np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows], float))


def judged(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and the posterior probability ``p_good`` of every document."""
    found = written(measured(docs), "quality")
    share, right = learned(found)
    for_good, for_bad = log_odds(right)
    odds = F.lit(float(np.log(share / (1 - share))))
    for j in range(RULES):
        vote = F.floor(F.col("pattern") / 3**j) % 3
        odds = odds + F.when(vote == 2, float(for_good[j])).when(vote == 0, float(for_bad[j])).otherwise(0.0)
    p_good = 1 / (1 + F.exp(-odds))
    kept = ~F.col("base_failed") & (p_good >= 0.5)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *counts, "base_failed", kept.alias("kept"), p_good.alias("p_good"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns: votes of all rows first, then one filtering pass."""
    share, right = learned(measured(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = _table(batch)
            good = posterior(votes(table), share, right) >= 0.5
            yield batch.filter(pa.array(good & ~base_failed(table)))

    return docs.mapInArrow(tidy(run), docs.schema)
