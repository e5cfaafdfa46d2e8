import math

from beaconlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id long, block long"


def plain(rows, k=5, every=50):
    usable = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v, *_ in rows
        if i is not None and v and all(x is not None and math.isfinite(256 * float(x)) for x in v)
    ]
    out = []
    for q, a in usable:
        if q % every == 0:
            found = [(sum(x * y for x, y in zip(a, b)), c) for c, b in usable if c != q and len(a) == len(b)]
            held = [(max(-(2**63), min(2**63 - 1, s)), c) for s, c in found]
            best = sorted(held, key=lambda f: (-f[0], f[1]))[:k]
            out += [(q, n + 1, c, s) for n, (s, c) in enumerate(best)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def test_ties_nulls_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(n, [0.5, -0.25, (n % 3) / 4], 1, 2, 3) for n in range(130)]
    rows += [(200, [0.1], 1, 2, 3), (250, [nan, 1.0, 1.0], 1, 2, 3), (251, [1.0, inf, 1.0], 0, 0, 0), (300, None, 0, 0, 0), (350, [], 0, 0, 0)]
    rows += [(None, [1.0, 1.0, 1.0], None, None, None), (400, [None, 1.0, 1.0], 0, 0, 0), (201, [2.0], 1, 1, 1), (500, [1.0] * 5, 1, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(topk.search(df)) == plain(rows)


def test_components_beyond_doubles(spark):
    rows = [(n, [1e30 if n == 7 else float(n), 2.0**40], 1, 2, 3) for n in range(12)]
    rows.append((50, [3.0, -(2.0**41)], 1, 2, 3))
    assert found(topk.search(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_the_whole_range_of_a_long(spark):
    tops = [2.0**18, 2.0**18 + 2.0**17, 2.0**19 - 2.0, 2.0**19, 2.0**20, -(2.0**18), -(2.0**19), -(2.0**21), 1e300, -1e300, 1e308, 3.0]
    rows = [(n + 1, [tops[n % len(tops)], float(n % 5)]) for n in range(30)] + [(50, [2.0**27, 1.0]), (100, [-(2.0**27), 1.0]), (150, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    expected = plain(rows, k=20)
    assert found(topk.search(df, k=20)) == expected
    assert len({s for *_, s in expected}) > 12 and 2**63 - 1 in {s for *_, s in expected}


def test_small_blocks(spark, data, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    df = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(topk.search(df, k=3, every=20)) == plain(rows, 3, 20)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.search(df).count() == 0
    assert topk.search(spark.createDataFrame([(3, [1.0], 0, 0, 0), (4, [1.0], 0, 0, 0)], SCHEMA)).count() == 0
