import sys
from collections import Counter

import pytest
from test_jaccard import plain as plain_groups
from test_repeats import SIZE
from test_tokens import check_packing

import corpus_pipeline
from beaconlake.llm import language, quality
from beaconlake.llm.common import fold_of
from beaconlake.session import written


def plain_cut(rows):
    texts = [(i, t.encode()) for i, t in rows]
    first = {}
    for i, raw in texts:
        for at in range(len(raw) - SIZE + 1):
            first[raw[at : at + SIZE]] = min(first.get(raw[at : at + SIZE], i), i)
    out = {}
    for i, raw in texts:
        gone = bytearray(len(raw))
        for at in range(len(raw) - SIZE + 1):
            if first[raw[at : at + SIZE]] < i:
                gone[at : at + SIZE] = b"\x01" * SIZE
        out[i] = bytes(b for b, g in zip(raw, gone) if not g).decode(errors="ignore")
    return out


def test_every_stage(spark, data, documents):
    docs, steps = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, data), "stage")
        steps[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.dtypes == documents.dtypes

    before, after = steps["language ID"]
    samples = {}
    for r in before.collect():
        if r.lang is not None and r.text is not None and fold_of(r.doc_id, 5):
            samples.setdefault(r.lang, []).append(r.text.encode())
    model = language.train(samples)
    names, scores = language.predicted(model, [(r.text or "").encode() for r in before.collect()])
    kept = {r.doc_id for r, n, s in zip(before.collect(), names, scores) if n != "und" and s >= 0.5}
    assert {r.doc_id for r in after.collect()} == kept

    before, after = steps["quality rules"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in quality.judged(before).collect() if r.kept}

    before, after = steps["n-gram Jaccard join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    groups = plain_groups(rows, 5, 80)
    assert {r.doc_id for r in after.collect()} == {i for i, n, c in groups if i == c}

    before, after = steps["suffix-array dedup"]
    expected = plain_cut([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id: r.text for r in after.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = steps["best-fit packing"]
    check_packing(after.collect(), [(r.doc_id, r.text) for r in before.collect()], 1024)


@pytest.mark.parametrize("rows", ["odd", "empty", "blank"])
def test_stages_on_odd_rows(spark, data, documents, odd, empty, rows):
    """Clashing columns, nulls in every column, repeated rows and ids; no rows at all; nothing but rows without a word."""
    blank = odd.where("text is null or trim(text) = ''")
    docs = {"odd": odd.unionByName(documents.limit(60), allowMissingColumns=True), "empty": empty, "blank": blank}[rows]
    kept = Counter(r.doc_id for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, data), "stage")
        assert after.dtypes == docs.dtypes, name
        found = Counter(r.doc_id for r in after.collect())
        assert found <= kept, name
        docs, kept = after, found
    pieces = written(corpus_pipeline.STAGES[-1][1](spark, docs, data), "stage").collect()
    assert Counter(p.doc_id for p in pieces if p.piece == 0) == kept
    assert bool(pieces) == (rows == "odd")


def test_run_equals_its_stages(spark, data, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, data), "stage")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, data).select(columns).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, docs.select(columns).collect()))


def test_labelled_good_documents_survive_the_filters(spark, data, documents):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    kept = {r.doc_id for r in quality.kept_documents(language.kept_documents(documents)).collect()}
    failed = {r.doc_id for r in quality.judged(documents).collect() if r.base_failed}
    good = [i for i, q in labels.items() if q == 1 and i not in failed]
    assert sum(i in kept for i in good) >= 0.95 * len(good)


def test_entry_lists_the_queries():
    sys.path.insert(0, str(corpus_pipeline.__file__).rsplit("/", 1)[0])
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names
    assert entry.oracle_sql().keys() <= names.keys()
    with pytest.raises(KeyError):
        names["op14"]
