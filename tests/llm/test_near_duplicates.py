import random

import numpy as np
import pytest
from test_jaccard import plain

from beaconlake.llm import near_duplicates as nd


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [tuple(r) for r in df.collect()]
    assert all(kept == (i == c) for i, _, c, kept in rows)
    return sorted((r[:3] for r in rows), key=str)


def random_set(draw, n):
    return np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))


def test_sketches_do_not_depend_on_neighbours_and_merge():
    draw = np.random.default_rng(1)
    sets = [random_set(draw, n) for n in (1, 2, 7, 160, 900, 20_000)]
    made = nd.sketches(sets)
    for s, registers in zip(sets, made):
        assert (nd.sketches([s])[0] == registers).all()
    both = nd.sketches([np.union1d(sets[3], sets[4])])[0]
    assert (both == np.maximum(made[3], made[4])).all()
    assert (made > 0).all() and (made < nd.LARGEST).all()


def test_registers_follow_the_size():
    draw = np.random.default_rng(2)
    for n in (1, 50, 3000):
        made = nd.sketches([random_set(draw, n) for _ in range(100)]).astype(float)
        # the mean of a register is that of -log_b of an exponential variable of rate RATE * n, plus one half
        expected = 0.5 + (np.log(nd.RATE * n) + 0.5772156649) / np.log(nd.BASE)
        assert abs(made.mean() - expected) < 40


@pytest.mark.parametrize("similarity", [0.0, 0.3, 0.6, 0.85, 0.95, 1.0])
def test_estimates_and_shared_bands_follow_the_similarity(similarity):
    draw = np.random.default_rng(3)
    common, own = round(400 * similarity), round(200 * (1 - similarity))
    pairs = []
    for _ in range(200):
        s = random_set(draw, common + 2 * own)
        pairs.append((np.delete(s, np.s_[:own]), np.delete(s, np.s_[own : 2 * own])))
    a, b = (nd.sketches([p[i] for p in pairs]) for i in (0, 1))
    n, m = (np.array([len(p[i]) for p in pairs]) for i in (0, 1))
    best, _ = nd.estimated(n.astype(float), m.astype(float), a, b)
    assert abs(best.mean() - similarity) < 0.02
    shared = (nd.bands(a) == nd.bands(b)).any(axis=1).mean()
    assert abs(shared - (1 - (1 - similarity**nd.BAND) ** nd.BANDS)) < 0.05
    kept = nd.likely(n, m, a, b, 85)
    assert kept.all() if similarity >= 0.85 else not kept.any() if similarity <= 0.3 else True


def families():
    """Chains, families just above and below the threshold, copies, and groups that share a bucket without linking."""
    draw = random.Random(4)
    rows, n = [], 0
    for family in range(12):
        base = [f"f{family}w{i}" for i in range(draw.choice((12, 60, 200, 900)))]
        for _ in range(draw.choice((2, 9, 40))):
            text = list(base)
            for _ in range(draw.randrange(1 + len(base) // 40)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
            rows.append((n, " ".join(text)))
            n += 1
            if draw.random() < 0.2:
                base = text
    return rows


def test_families_of_near_copies(spark):
    rows = families()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(nd.grouped(df)) == plain(rows, 5, 85)
    assert found(nd.grouped(df, block=500)) == plain(rows, 5, 85)


def test_crowds_that_the_hub_does_not_join(spark):
    # the smallest node of a bucket may be an outlier: pairs beside it are found only by looking at all parts of a bucket
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join("y" if i in (k, k + 3 + k % 5) else w for i, w in enumerate(base)) for k in range(90)]
    rows = [*enumerate(texts), *((200 + k, t + " end") for k, t in enumerate(texts[::9]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (nd.BLOCK, 300):
        assert found(nd.grouped(df, block=block)) == plain(rows, 5, 85)
        assert found(nd.grouped(df, percent=93, block=block)) == plain(rows, 5, 93)


def test_rest_joins_what_no_hub_does(spark):
    """All pairs of different parts of a group meet, wherever their blocks are."""
    draw = random.Random(9)
    texts = [" ".join(f"g{k // 6}w{i}" if i != draw.randrange(120) else f"z{k}" for i in range(120)) for k in range(48)]
    nodes = [(7, k, 100 if k < 12 else k, 116) for k in range(48)]
    members = spark.createDataFrame(nodes, "hub long, node long, part long, n long")
    held = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    for block in (1 << 20, 1000, 200):
        above = list(range(48))

        def root(i):
            while above[i] != i:
                i = above[i]
            return i

        for k in range(1, 12):
            above[root(k)] = root(0)
        for a, b in nd._rest_links(members, held, 5, 85, block).collect():
            assert nodes[a][2] != nodes[b][2]
            above[root(a)] = root(b)
        groups = [c for _, _, c in sorted(plain(list(enumerate(texts)), 5, 85))]
        assert [[root(a) == root(b) for a in range(12, 48)] for b in range(12, 48)] == [[groups[a] == groups[b] for a in range(12, 48)] for b in range(12, 48)]


def test_odd_documents(odd, odd_rows):
    assert found(nd.grouped(odd)) == plain([r[:2] for r in odd_rows], 5, 85)


def test_whole_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(nd.grouped(documents)) == plain(rows, 5, 85)


def test_documents_that_share_an_id_or_lack_one(spark):
    def text(name, k=None):
        return " ".join("other" if i == k else f"{name}{i}" for i in range(120))

    rows = [(5, text("a")), (None, text("a", 50)), (9, text("b")), (None, text("b", 60)), (None, text("c")), (None, text("c", 0))]
    rows += [(None, text("d")), (None, text("d")), (7, text("e")), (7, text("f")), (3, text("f", 119)), (7, text("g")), (None, None)]
    rows += [(8, text("h"))] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(nd.grouped(df)) == plain(rows, 5, 85)


def test_no_rows(empty):
    assert nd.grouped(empty).count() == 0
