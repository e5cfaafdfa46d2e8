import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from beaconlake.llm import repeats
from beaconlake.llm.suffixes import suffix_array

SIZE = 50
LAST = 2**63 - 1


def plain(rows, size=SIZE):
    """Every string of every text in one dictionary."""
    texts = [((LAST if i is None else i), (t or "").encode()) for i, t in rows]
    first = {}
    for i, raw in texts:
        for at in range(len(raw) - size + 1):
            s = raw[at : at + size]
            first[s] = min(first.get(s, i), i)
    out = []
    for (doc_id, _), (i, raw) in zip(rows, texts):
        gone = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - size + 1):
            if first[raw[at : at + size]] < i:
                gone[at : at + size] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


@pytest.mark.parametrize("symbols", [2, 3, 50])
def test_suffix_arrays(symbols):
    draw = random.Random(symbols)
    for n in [*range(30), 200]:
        text = np.array([draw.randint(1, symbols - 1) for _ in range(n)], np.int64)
        assert suffix_array(text, symbols).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())


def test_wide_alphabets():
    text = np.random.default_rng(1).integers(1, 2**22, 500)
    text[200:300] = text[:100]
    assert suffix_array(text, 2**22).tolist() == sorted(range(500), key=lambda i: text[i:].tolist())


def test_odd_documents(odd, odd_rows):
    assert found(repeats.deduplicated(odd)) == plain([r[:2] for r in odd_rows])


def test_whole_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(repeats.deduplicated(documents)) == plain(rows)


def test_crowded_anchors_give_the_same(odd, odd_rows):
    assert found(repeats.deduplicated(odd, crowd=1)) == plain([r[:2] for r in odd_rows])


def test_long_strings(spark):
    draw = random.Random(3)
    text = "".join(draw.choices("abcdefgh ", k=6000))
    rows = [(1, text), (2, f"x{text}y"), (3, f"{text[:2500]}-{text[2600:]}"), (4, text), (None, text[1000:1400]), (5, text[7:405])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for crowd in (repeats.CROWD, 1):
        assert found(repeats.deduplicated(docs, size=400, crowd=crowd)) == plain(rows, 400)


def test_empty_table(empty):
    assert repeats.deduplicated(empty).count() == 0 and repeats.kept_documents(empty).count() == 0


def test_filtered_documents_keep_their_columns(odd):
    kept = repeats.kept_documents(odd)
    assert kept.schema.simpleString() == odd.schema.simpleString() and kept.count() == odd.count()
    by_id = {r.doc_id: r for r in kept.collect()}
    assert by_id[1].text == "" and by_id[1].n_chars == 0 and by_id[6].text is None
    assert by_id[0].text.startswith("w") and by_id[4].text.startswith("start") and len(by_id[4].text) < 20


def test_rows_of_one_id_whose_short_hashes_clash(spark):
    """Two texts without an id that share a 32-bit hash keep their own covers."""
    passage = " ".join(f"word{i}" for i in range(20))
    texts = spark.range(400_000).select(F.concat(F.lit(passage + " "), F.col("id").cast("string")).alias("text"))
    pairs = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("same")).where("size(same) > 1").collect()
    assert pairs
    short = [(None, t) for row in pairs for t in row.same] + [(None, passage[:6]), (None, passage[:6]), (7, passage), (7, "x" + passage)]
    rows = [(1, passage), *short, *[(None, passage + " again")] * 40]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(repeats.deduplicated(df)) == plain(rows)


def test_hashes_across_blocks():
    n = 2 * repeats.BLOCK + 100
    data = np.random.default_rng(4).integers(0, 256, n).astype(np.uint8)
    hashes = repeats.Hashes(data)
    grams = hashes.grams(20)
    places = np.array([0, 1, repeats.BLOCK - 20, repeats.BLOCK - 1, repeats.BLOCK, 2 * repeats.BLOCK - 7, n - 20])
    alone = [repeats.Hashes(data[p : p + 20]).grams(20)[0] for p in places]
    assert len(grams) == n - 19
    assert grams[places].tolist() == alone == hashes.of(places, places + 20).tolist()
    values = np.random.default_rng(5).integers(0, 1000, repeats.BLOCK + 300)
    found = repeats.leftmost_smallest(values, 31)
    assert found.tolist() == [i + int(values[i : i + 31].argmin()) for i in range(len(values) - 30)]


def test_anchors_take_little_memory():
    """Arrays on the way to the anchors of a slice, and powers held for later, as other workers of the machine need room."""
    draw = np.random.default_rng(6)
    data = draw.integers(97, 101, repeats.SLICE).astype(np.uint8)
    starts = np.arange(0, len(data), 2000)
    tracemalloc.start()
    try:
        repeats.anchored(data, starts, np.append(starts[1:], len(data)), SIZE, repeats.GRAM)
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert most < 32 * len(data)
    assert held < len(data)


def crowded_contexts(n):
    """Contexts of one anchor, a common passage that meets few kinds of neighbours on either side."""
    draw = random.Random(12)
    sides = [bytes(draw.choices(range(97, 123), k=29)) for _ in range(40)]
    pieces = [draw.choice(sides) + b"a passage of 20 byte" + draw.choice(sides) for _ in range(n)]
    ids = np.array([draw.randrange(5 * n) for _ in range(n)])
    table = pa.table({
        "id": ids, "key": np.arange(n), "part": np.zeros(n, np.int32), "crowd": np.zeros(n, bool),
        "start": np.arange(n, dtype=np.int32) % 7, "bytes": pa.array(pieces, pa.binary()),
    })
    return ids, pieces, table


def test_contexts_of_one_anchor_take_little_memory():
    ids, pieces, table = crowded_contexts(40_000)
    tracemalloc.start()
    covers = repeats.compared(SIZE)((0,), table)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 120e6
    first = {}
    for i, raw in zip(ids.tolist(), pieces):
        for at in range(len(raw) - SIZE + 1):
            first[raw[at : at + SIZE]] = min(first.get(raw[at : at + SIZE], i), i)
    expected = {
        (k, k % 7 + at) for k, (i, raw) in enumerate(zip(ids.tolist(), pieces)) for at in range(len(raw) - SIZE + 1) if first[raw[at : at + SIZE]] < i
    }
    got = set()
    for row in covers.to_pylist():
        for start, n in zip(np.frombuffer(row["start"], "<u4").tolist(), np.frombuffer(row["strings"], "<u1").tolist()):
            got |= {(row["key"], start + x) for x in range(n)}
    assert got == expected


def test_groups_beyond_the_bound_give_the_same(monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 300)
    ids, pieces, _ = crowded_contexts(300)
    hit = repeats.covered_strings(ids, pieces, SIZE)
    offset = np.cumsum([0, *(len(p) + 1 for p in pieces)])
    got = np.zeros(len(hit), bool)
    for piece, place, n in repeats.covered_runs(ids, pieces, SIZE):
        for p, at, m in zip(piece.tolist(), place.tolist(), n.tolist()):
            got[offset[p] + at : offset[p] + at + m] = True
    assert hit.any() and (got == hit).all()
