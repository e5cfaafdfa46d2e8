import random
import time
from collections import Counter
from itertools import combinations

from pyspark.sql import functions as F

from beaconlake.llm import jaccard
from beaconlake.llm.components import components
from beaconlake.session import written


def shingles(text, words):
    raw = bytes((text or "").encode()).lower().split()
    if len(raw) < words:
        return frozenset([tuple(raw)] if raw else [])
    return frozenset(tuple(raw[i : i + words]) for i in range(len(raw) - words + 1))


def plain(rows, words=3, percent=90):
    sets = [shingles(t, words) for _, t in rows]
    above = list(range(len(rows)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    by_set = {}
    for i, s in enumerate(sets):
        if s:
            above[root(i)] = root(by_set.setdefault(s, i))
    for a, b in combinations(by_set, 2):
        if min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
            above[root(by_set[a])] = root(by_set[b])
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        key = 2**63 if doc_id is None else doc_id
        least[root(i)] = min(least.get(root(i), 2**63), key)
    named = [least[root(i)] for i in range(len(rows))]
    return sorted(
        ((i, len(s), None if n == 2**63 else n) for (i, _), s, n in zip(rows, sets, named)), key=str
    )


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_odd_documents(odd, odd_rows):
    assert found(jaccard.linked_documents(odd)) == plain([r[:2] for r in odd_rows])


def test_whole_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(jaccard.linked_documents(documents)) == plain(rows)
    assert found(jaccard.linked_documents(documents, words=5, percent=80)) == plain(rows, 5, 80)


def test_no_link_is_lost_in_blocks(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    assert found(jaccard.linked_documents(odd)) == plain([r[:2] for r in odd_rows])


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    """Very long near copies: no group of two blocks holds many more shingles than two blocks may."""
    draw = random.Random(8)
    base = [f"w{i}" for i in range(3000)]
    texts = [" ".join("x" if draw.random() < 0.01 else w for w in base) for _ in range(240)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(jaccard, "SHINGLES", 60_000)
    monkeypatch.setattr(jaccard, "CHECKED_SHINGLES", 10_000)
    seen = []
    keep = jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: seen.append((name, df)) or keep(df, name))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(jaccard.linked_documents(df)) == plain(rows)

    met_rows = next(df for name, df in seen if name == "jaccard")
    groups = jaccard.dealt_sets(jaccard._keyed(df), met_rows, 3).groupBy("cluster", "left", "right")
    groups = groups.agg(F.sum(F.length("shingles") / 8).alias("n"), F.count("*").alias("sets"))
    assert groups.where("sets > 20").count() > 10 and groups.agg(F.max("n")).first()[0] < 2 * 60_000 * 1.7


def test_trees_find_what_pairs_find():
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]) for k in range(0, 300, 3)] + [" ".join(base[k:]) for k in range(0, 200, 5)]
    sets = jaccard.shingle_sets([t.encode() for t in texts])
    part = list(range(len(texts)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    links = jaccard.joining_links(sets)
    for a, b in links:
        part[max(root(a), root(b))] = min(root(a), root(b))
    rows = list(enumerate(texts))
    assert [root(i) for i in range(len(texts))] == [c for _, _, c in sorted(plain(rows), key=lambda r: r[0])]
    assert len(links) == len(texts) - len({root(i) for i in range(len(texts))})


def test_documents_that_share_an_id_or_lack_one(spark):
    def text(name, k=None):
        return " ".join("other" if i == k else f"{name}{i}" for i in range(120))

    rows = [(5, text("a")), (None, text("a", 50)), (9, text("b")), (None, text("b", 60)), (None, text("c")), (None, text("c", 0))]
    rows += [(None, text("d")), (None, text("d")), (7, text("e")), (7, text("f")), (3, text("f", 119)), (7, text("g")), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(jaccard.linked_documents(df)) == plain(rows)
    kept = Counter(tuple(r) for r in jaccard.kept_documents(df, words=3, percent=90).collect())
    one_of_c = {rows[4], rows[5]} & kept.keys()
    assert len(one_of_c) == 1
    assert kept == Counter([rows[0], rows[2], *one_of_c, rows[6], rows[8], rows[10], rows[11], rows[12]])


def test_empty_table(empty):
    assert jaccard.linked_documents(empty).count() == 0 and jaccard.kept_documents(empty).count() == 0


def test_one_of_each_group_stays(odd, odd_rows):
    kept = jaccard.kept_documents(odd, words=3, percent=90)
    assert kept.schema.simpleString() == odd.schema.simpleString()
    groups = plain([r[:2] for r in odd_rows])
    real = {c for _, n, c in groups if n}
    bare = sum(n == 0 for _, n, _ in groups)
    assert kept.count() == len(real) + bare
    assert {r.doc_id for r in kept.collect() if (r.text or "").strip()} == real


def test_components_of_long_chains(spark):
    chain = [(n, n + 1) for n in range(0, 60)] + [(100, 200), (200, 150)]
    edges = spark.createDataFrame(chain, "a long, b long").repartition(7)
    names = {r.id: r.component for r in components(edges).collect()}
    assert names == {**{n: 0 for n in range(61)}, 100: 100, 150: 100, 200: 100}


def test_passages_do_not_chain_unrelated_texts(spark, monkeypatch):
    """Texts that share passages with others, each with a few of them, and one pair that links: only the pair is dealt."""
    draw = random.Random(15)
    passages = [" ".join(f"p{k}x{i}" for i in range(50)) for k in range(6)]
    texts = []
    for n in range(150):
        own = [f"t{n}x{i}" for i in range(300)]
        texts.append(" ".join([*own[:150], draw.choice(passages), *own[150:], draw.choice(passages)]))
    texts.append(texts[0].replace("t0x9 ", "other "))
    rows = list(enumerate(texts))
    seen = []
    keep = jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: seen.append((name, df)) or keep(df, name))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(jaccard.linked_documents(df, words=5, percent=80)) == plain(rows, 5, 80)
    met_rows = next(df for name, df in seen if name == "jaccard")
    nodes = jaccard.dealt_sets(jaccard._keyed(df), met_rows, 5).select("node").distinct().count()
    assert 2 <= nodes <= 10


def test_shuffles_of_written_tables_take_no_disk(spark):
    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(held.size()) if (name := held.apply(i).getName()).startswith("shuffle_")}

    before = files()
    table = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count"), "shuffled")
    for _ in range(50):  # they go in the background
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert table.count() == 7 and not left
