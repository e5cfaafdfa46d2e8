import math

import numpy as np
import pytest

from beaconlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, block long, dim string"
TOP = 2**63 - 1


def plain(rows, every=100):
    usable = []
    for i, v, label, *_ in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) or math.isinf(256 * x) for x in v):
            continue
        usable.append((i, [math.floor(256 * x) for x in v], int(math.fmod(label + 1, 10)) if i % 7 == 0 else label))
    out = []
    for a, v, label in usable:
        if a % every:
            continue
        scores = [(max(-TOP - 1, min(TOP, sum(x * y for x, y in zip(v, w)))), i, m) for i, w, m in usable if i != a and len(w) == len(v)]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for top, p, _ in [s for s in scores if s[2] == label][:5]:
            window = [(s, i) for s, i, m in scores if m != label and 80 * top <= 100 * s <= 100 * top][:5]
            out += [(a, p, n + 1, i, top, s) for n, (s, i) in enumerate(window)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bound", [0, 1, 200, 10**6, 2**61, 2**63, 2**200, 2**2100])
def test_moduli_tell_all_scores_apart(bound):
    product = math.prod(hn.moduli(bound))
    assert product > 2 * bound and len(set(hn.moduli(bound))) == len(hn.moduli(bound))


@pytest.mark.parametrize(("top", "dim"), [(100, 64), (2**14, 5000), (2**30, 70), (2**31, 3), (2**45, 9)])
def test_scores_are_exact(top, dim):
    draw = np.random.default_rng(dim)
    q, c = (draw.integers(-top, top, (n, dim), endpoint=True) for n in (5, 7))
    chosen = hn.moduli(top * top * dim)
    rests = [hn.product_modulo(hn.residues(q.astype(float), p), hn.residues(c.astype(float), p), p) for p in chosen]
    expected = np.clip(q.astype(object) @ c.astype(object).T, -TOP - 1, TOP)
    assert (hn.remaindered(rests, chosen) == expected).all()


def test_windows_at_the_ends_of_a_long():
    tops = [0, 1, 4, 5, 99, 101, -1, -5, -7, TOP, TOP - 3, -TOP - 1]
    assert hn.least_score(np.array(tops, np.int64), 80).tolist() == [-(-80 * t // 100) for t in tops]
    places = hn.first(np.array([3, -TOP - 1, TOP, 3, 3, TOP]), np.array([9, 1, 8, 2, 5, 7]), 4)
    assert places.tolist() == [5, 2, 3, 4]


def test_ties_nulls_lengths_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(n, [0.5, -0.25, (n % 5) / 4 - 0.5], n % 3, 2, "x") for n in range(230)]
    rows += [(300, [0.1], 1, 2, "x"), (400, [nan, 1.0, 1.0], 1, 2, "x"), (251, [1.0, inf, 1.0], 0, 0, None), (500, None, 0, 0, ""), (600, [], 0, 0, "")]
    rows += [(None, [1.0] * 3, 1, None, None), (700, [None, 1.0, 1.0], 0, 0, "x"), (301, [2.0], 1, 1, "x"), (302, [2.0], 2, 1, "x"), (800, [1.0] * 3, None, 1, "x")]
    rows += [(303, [1e308] * 3, 1, 1, "x"), (304, [1.0] * 3, -3, 1, "x"), (308, [1.0] * 3, -13, 1, "x"), (900, [-1.0] * 3, 0, 1, "x")]
    rows += [rows[100], rows[100], rows[7], rows[12], rows[13]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(hn.mined(df)) == plain(rows)


def test_scores_up_to_and_beyond_the_range_of_a_long(spark):
    tops = [2.0**18, 2.0**18 + 2.0**17, 2.0**19, 2.0**22, 2.0**23, 2.0**40, 1e100, -(2.0**18), 3e18, 1e300]
    rows = [(n, [tops[n % 10], float(n)], n % 2, 1, "x") for n in range(60)] + [(100 * n, [2.0**27, float(n)], n % 3, 1, "x") for n in (1, 2, 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(hn.mined(df)) == plain(rows)


def test_whole_embeddings_in_small_blocks(spark, data, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "ROWS", 60)
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert found(hn.mined(df)) == plain(rows) != []
    assert found(hn.mined(df.repartition(9), every=50)) == plain(rows, 50)


def test_no_rows(spark):
    assert hn.mined(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.mined(spark.createDataFrame([(0, [1.0], 1, 1, ""), (3, [1.0], 2, 1, "")], SCHEMA)).count() == 0
