import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from beaconlake.llm import language, maxent, quality


def in_fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


# Language model


def base_scores(rows):
    training = Counter()
    for i, t in rows:
        if in_fold(i, 5) != 1:
            training.update([*(t or "").encode().lower().split(), None])
    total, kinds = sum(training.values()), len(training)
    out = {}
    for i, t in rows:
        parts = [*(t or "").encode().lower().split(), None]
        base = math.fsum(math.log10((training[p] + 0.5) / (total + 0.5 * (kinds + 1))) for p in parts)
        out.setdefault(i, []).append((in_fold(i, 5) == 1, len(parts), sum(training[p] > 0 for p in parts), total, round(base, 6)))
    return {i: sorted(v) for i, v in out.items()}


def scored(df):
    out = {}
    for r in maxent.scored(df).collect():
        out.setdefault(r.doc_id, []).append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
    return {i: sorted(v) for i, v in out.items()}


def test_base_scores(odd, odd_rows, empty, monkeypatch):
    assert scored(odd) == base_scores([r[:2] for r in odd_rows])
    monkeypatch.setattr(maxent, "LOOKUP", 8)  # nearly all counts come by the join
    assert scored(odd) == base_scores([r[:2] for r in odd_rows])
    assert maxent.scored(empty).count() == 0


def test_model_beats_the_base_on_held_out_documents(documents):
    rows = maxent.scored(documents).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_probabilities_sum_to_one():
    counts = {b"a": 5, b"b": 3, maxent.END: 2, b"c": 1}
    head = {maxent.END: 0, b"a": 1}
    tails, kinds = np.zeros(maxent.TAILS, np.int64), np.zeros(maxent.TAILS, np.int64)
    for w in (b"b", b"c"):
        tails[maxent.tail_class(w)] += counts[w]
        kinds[maxent.tail_class(w)] += 1
    v = maxent.Vocabulary(counts, head, 11, 4, tails, kinds)
    weights = maxent.initial(v)
    draw = np.random.default_rng(0)
    weights.outer += draw.normal(size=weights.outer.shape).astype(np.float32)
    weights.inner += draw.normal(size=weights.inner.shape).astype(np.float32)
    context = maxent.HEAD_WORDS + 3 << 11
    total = 0.0
    for kind in range(maxent.CLASSES):
        for place in range(maxent.WIDTH if kind < maxent.HEADS else 1):
            log = maxent.token_scores(weights, v, np.array([context, kind << 5 | place]), np.array([0]))[1]
            mass = 1 if kind < maxent.HEADS else tails[kind - maxent.HEADS] + 0.5 * (kinds[kind - maxent.HEADS] + 1)
            total += math.exp(log) * mass
    assert total == pytest.approx(1, abs=1e-4)


# Language identification


def plain_bits(samples, known, text, order=language.ORDER):
    """Code length with dictionaries of all contexts."""
    seen = {}
    for s in samples:
        padded = b"\x00" * order + s
        for at in range(order, len(padded)):
            for k in range(order + 1):
                # a context that reaches before the text holds the mark of the start
                key = tuple(padded[j] if j >= order else None for j in range(at - k, at))
                seen.setdefault(key, Counter())[padded[at]] += 1
    bits = 0.0
    for at in range(len(text)):
        cost, k = 0.0, order
        byte = text[at]
        while True:
            if k < 0:
                cost += 8
                break
            key = tuple(text[j] if j >= 0 and text[j] in known else None for j in range(at - k, at))
            counts = seen.get(key)
            if counts:
                n, kinds = sum(counts.values()), len(counts)
                if byte in counts:
                    cost -= math.log2(counts[byte] / (n + kinds))
                    break
                cost -= math.log2(kinds / (n + kinds))
            k -= 1
        bits += cost
    return bits


def test_code_lengths_are_exact():
    samples = {"x": [b"the cat sat on the mat", b"a hat"], "y": ["der hut ist grün".encode(), b"die katze"]}
    model = language.train(samples)
    texts = [b"the hat", "grüne katze Q!".encode(), b"z", b"\x00\x00", b""]
    found = language.code_lengths(model, texts)
    known = {byte for texts_of in samples.values() for t in texts_of for byte in t}
    for text, row in zip(texts, found):
        for name, bits in zip(model.languages, row):
            assert bits == pytest.approx(plain_bits(samples[name], known, text), abs=1e-3)


def test_long_texts_in_slices(monkeypatch):
    model = language.train({"x": [b"the cat sat on the mat"], "y": [b"die katze"]})
    text = b"the katze sat " * 40
    whole = language.code_lengths(model, [text])
    monkeypatch.setattr(language, "SLICE", 37)
    assert np.allclose(language.code_lengths(model, [text, b"a", text])[[0, 2]], whole)


def test_numerals_are_no_letters(spark, documents):
    odd = ["²", "½ ① 12", "Ⅷ", "_ 1", "ª", "é", "中", "١٢", "x²"]
    rows = [(10**9 + n, t, None) for n, t in enumerate(odd)]
    both = documents.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = {r.doc_id - 10**9: r.lang_pred for r in language.identified(both).where(f"doc_id >= {10**9}").collect()}
    assert [found[n] == "und" for n in range(len(odd))] == [not any(c.isalpha() for c in t) for t in odd]
    assert found[0] == found[1] == "und" != found[5]


def test_held_out_accuracy(documents):
    rows = language.identified(documents).collect()
    langs = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in langs if in_fold(i, 5) == 0}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_copied_texts_teach_once_and_no_language_is_lost(spark, monkeypatch):
    taught = []
    monkeypatch.setattr(language, "SAMPLE_BYTES", 2000)
    monkeypatch.setattr(language, "train", lambda samples: taught.append(samples))
    rows = [(n, f"text {n % 400} of many words", "en") for n in range(2000)]
    rows += [(n, f"eine kopie {n % 2}", "de") for n in range(2000, 6000)] + [(n, "x" * 5000, "fr") for n in range(6000, 6100)]
    language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
    found = taught[0]
    assert found.keys() == {"en", "de", "fr"} and all(len(set(t)) == len(t) for t in found.values())
    assert 2000 <= sum(map(len, found["en"])) < 2030
    assert found["de"] == [b"eine kopie 0", b"eine kopie 1"] and found["fr"] == [b"x" * 5000]


def test_long_texts_teach_beyond_their_heads(spark, monkeypatch):
    taught = []
    monkeypatch.setattr(language, "train", lambda samples: taught.append(samples))
    texts = [" ".join(f"é{name}{n}" for n in range(60_000)) for name in ("eins", "zwei")]
    docs = spark.createDataFrame([(n, t, "de") for n, t in enumerate(texts * 3)], "doc_id long, text string, lang string")
    language.fit(docs)
    assert taught[0] == {"de": sorted(t.encode() for t in texts)}
    monkeypatch.setattr(language, "SAMPLE_BYTES", 400_000)
    language.fit(docs)
    found = taught[1]["de"]
    assert 400_000 <= sum(map(len, found)) < 400_000 + (1 << 16)
    assert any(t.encode().find(piece) > 65_536 for piece in found for t in texts)


def test_odd_languages(odd, odd_rows, empty):
    found = language.identified(odd).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        texts = [t for i, t, *_ in odd_rows if i == r.doc_id]
        if all(t is None or not any(c.isalpha() for c in t) for t in texts):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in found} <= {"en", "de", "und"}
    assert language.identified(empty).count() == 0
    kept = language.kept_documents(odd)
    assert kept.schema.simpleString() == odd.schema.simpleString() and 0 < kept.count() < len(odd_rows)


# Quality rules


def base_counts(text):
    raw = (text or "").encode()
    found = raw.split()
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    lines = [line for line in raw.split(b"\n") if line.split()]
    chars = sum(len(w.decode()) for w in found)
    return len(found), chars, sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_counts(odd, odd_rows, documents, empty):
    for df, rows in ((odd, [r[:2] for r in odd_rows]), (documents, [tuple(r) for r in documents.select("doc_id", "text").collect()])):
        expected = []
        for i, t in rows:
            n, *rest = base_counts(t)
            expected.append((i, n, *rest, n < 10 or 100 * rest[-1] > 20 * n))
        found = quality.judged(df).collect()
        assert sorted((tuple(r)[:7] for r in found), key=str) == sorted(expected, key=str)
        assert not any(r.kept and r.base_failed for r in found)
    assert quality.judged(empty).count() == 0 and quality.kept_documents(empty).count() == 0


def test_votes_agree_with_labels(documents, spark, data):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    found = [(labels[r.doc_id], r.kept, r.base_failed) for r in quality.judged(documents).collect() if r.doc_id in labels]
    good = [kept for label, kept, failed in found if label == 1 and not failed]
    bad = [kept for label, kept, _ in found if label == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_filter_equals_verdicts(odd, documents):
    for df in (odd, documents):
        kept = quality.kept_documents(df)
        assert kept.schema.simpleString() == df.schema.simpleString()
        verdicts = Counter(r.doc_id for r in quality.judged(df).collect() if r.kept)
        assert Counter(r.doc_id for r in kept.collect()) == verdicts


def test_estimates_do_not_depend_on_order():
    patterns = np.arange(0, 3**quality.RULES, 977)
    times = np.arange(1, len(patterns) + 1).astype(float)
    share, right = quality.estimate(patterns, times)
    back, again = quality.estimate(patterns[::-1], times[::-1])
    assert share == pytest.approx(back) and np.allclose(right, again)


def test_raw_texts_reads_both_widths():
    from beaconlake.llm.common import raw_texts

    for kind in (pa.string(), pa.large_string()):
        batch = pa.RecordBatch.from_arrays([pa.array(["é", None, ""], kind)], names=["text"])
        assert list(raw_texts(batch)) == ["é".encode(), b"", b""]


@pytest.mark.parametrize("most", [1, 3, 10, 40, 1000])
def test_the_smallest_count_that_few_words_reach(spark, most):
    draw = random.Random(most)
    for values in ([], [1] * 50, [draw.choice((1, 1, 2, 3, 5, 900, 10**9, 10**12)) for _ in range(60)], [draw.randrange(1, 10**6) for _ in range(80)]):
        counts = spark.createDataFrame([(b"%d" % i, n) for i, n in enumerate(values)], "word binary, n long")
        found = maxent.least_count(counts, most, cells=7)
        expected = next(n for n in [1, *sorted({v + 1 for v in values})] if sum(v >= n for v in values) <= most)
        assert sum(v >= found for v in values) == sum(v >= expected for v in values)


def test_tokens_are_words_and_an_end():
    texts = ["", " ", "One  two\tTHREE\n", "\x0b\x0ca\r b", "é É ÀB", "x" * 1000, "a\x1cb \x85 c　d", "one one"]
    found = maxent.coded_tokens([t.encode() for t in texts])
    ends = [*found.starts[1:], len(found.index)]
    got = [[found.words[i] for i in found.index[a:b]] for a, b in zip(found.starts, ends)]
    assert got == [[*t.encode().lower().split(), maxent.END] for t in texts]


def plain_log10(w, v, counts, words_):
    """Log probability of a text, token by token."""
    context, out = [], 0.0
    for word in words_:
        last = context[-1] if context else 0
        skip = context[-2] if len(context) > 1 else 0
        pair = (last * 40503 + skip * 30011 + 7) % 1_000_003 % maxent.PAIRS
        rows = [last, maxent.CONTEXTS + skip, 2 * maxent.CONTEXTS + pair]
        classes = np.exp((w.outer[rows].astype(float).sum(0) + w.outer[-1]))
        at = v.head.get(word)
        kind = maxent.HEADS + maxent.tail_class(word) if at is None else at // maxent.WIDTH
        out += math.log10(classes[kind] / classes.sum())
        if at is None:
            tail = kind - maxent.HEADS
            out += math.log10((counts[word] + 0.5) / (v.tail_total[tail] + 0.5 * (v.tail_distinct[tail] + 1)))
        else:
            chosen = [((r * 64 + kind) * 48271 + 11) % 2_147_483_647 % maxent.INNER for r in rows[:2]] + [maxent.INNER + kind]
            inner = np.exp(w.inner[chosen].astype(float).sum(0))
            out += math.log10(inner[at % maxent.WIDTH] / inner.sum())
        context.append(maxent.HEAD_WORDS + maxent.ending(word) if at is None else at)
    return out


def test_scores_equal_a_plain_model(spark, documents, monkeypatch):
    monkeypatch.setattr(maxent, "LOOKUP", 600)  # most words meet their counts by the join
    df = documents.select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, " the THE zzz")], "doc_id long, text string"))
    made = {}
    train = maxent.trained
    monkeypatch.setattr(maxent, "trained", lambda docs, v: made.setdefault("w", (train(docs, v), v))[0])
    found = {r.doc_id: r for r in maxent.scored(df).collect()}
    w, v = made["w"]
    parts = {r.doc_id: [*(r.text or "").encode().lower().split(), maxent.END] for r in df.collect()}
    counts = Counter(t for i, p in parts.items() if in_fold(i, 5) != 1 for t in p)
    assert len(v.count) <= 600 < len(counts)
    for i, words_ in sorted(parts.items(), key=lambda p: len(p[1]))[:150]:
        assert found[i].n_known == sum(counts[t] > 0 for t in words_)
        assert math.isclose(found[i].score, plain_log10(w, v, counts, words_), rel_tol=1e-5, abs_tol=1e-4)


def test_a_step_equals_plain_gradients():
    draw = np.random.default_rng(5)
    v = maxent.Vocabulary({}, {}, 0, 0, np.ones(maxent.TAILS, np.int64), np.ones(maxent.TAILS, np.int64))
    start = maxent.initial(v)
    start.outer += draw.normal(0, 0.1, start.outer.shape).astype(np.float32)
    start.inner += draw.normal(0, 0.1, start.inner.shape).astype(np.float32)
    word, kind = draw.integers(0, 40, 30), draw.integers(0, maxent.CLASSES, 30)
    place = draw.integers(0, maxent.WIDTH, 30)
    rows = maxent.feature_rows(word, np.array([0, 11]))
    trainer = maxent.Trainer(start)
    trainer.step(rows, kind, place)
    outer, seen = start.outer.astype(float).copy(), np.full(len(start.outer), 1e-2)
    slopes = []
    for t in range(30):
        e = np.exp(start.outer[rows[:, t]].astype(float).sum(0) + start.outer[-1])
        slope = e / e.sum()
        slope[kind[t]] -= 1
        slopes.append(slope)
    for feature in rows:
        for r in set(feature.tolist()):
            total = sum(s for s, f in zip(slopes, feature) if f == r)
            seen[r] += (total**2).mean()
            outer[r] -= total * maxent.RATE / math.sqrt(seen[r])
    assert np.allclose(trainer.w.outer, outer, atol=1e-4)
    assert (trainer.touched[0][np.unique(rows)] > 0).all() and trainer.touched[0].sum() == 90


def plain_votes(text):
    """Votes of the ten rules and the base verdict, counted character by character."""
    words_ = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    n, chars = len(words_), sum(map(len, words_))
    windows = [tuple(words_[i : i + 5]) for i in range(n - 4)]
    repeated = len({j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)})
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    marks = sum("!" <= c <= "~" and not c.isalpha() for c in text)
    symbols, digits, upper = (sum(c in kind for c in text) for kind in ("#*$%&|<>", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    bare = sum(len(w) == 1 and "!" <= w <= "~" and not w.isalnum() for w in words_)
    failed = n < 10 or 100 * repeated > 20 * n
    m, c = max(n, 1), max(chars, 1)
    dup = (len(lines) - len(set(lines))) / max(len(lines), 1)
    spread = len(set(words_)) / m

    def vote(bad, good):
        return -1 if bad else 1 if good else 0

    return failed, [
        vote(n < 10, n >= 30), vote(chars / m < 2.5 or chars / m > 14, 3 <= chars / m <= 10), vote(symbols / m > 0.1, symbols / m <= 0.02),
        vote(marks / c > 0.2, marks / c <= 0.08), vote(upper / c > 0.3, upper / c <= 0.1), vote(dup > 0.3, dup <= 0.1 and len(lines) >= 3),
        vote(repeated / m > 0.2, repeated / m <= 0.05 and n >= 50), vote(50 <= n < 1000 and spread < 0.25, n >= 50 and spread > 0.45),
        vote(digits / c > 0.2, digits / c <= 0.05), vote(bare / m > 0.15, bare / m <= 0.03),
    ]


def test_verdicts_equal_a_plain_em(documents):
    """Expectation-maximisation over single documents instead of counts of patterns."""
    rows = [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect() if len(r.text or "") < 20_000]
    cast = {i: plain_votes(t) for i, t in rows}
    share, right = 0.8, [[0.3] * 10, [0.97] * 10]

    def p_good(votes_):
        odds = math.log(share / (1 - share))
        for j, v in enumerate(votes_):
            if v:
                odds += math.log(right[1][j] / (1 - right[0][j])) if v > 0 else math.log((1 - right[1][j]) / right[0][j])
        return 1 / (1 + math.exp(-odds))

    for _ in range(200):
        good = {i: p_good(v) for i, (_, v) in cast.items()}
        new = [[0.0] * 10, [0.0] * 10]
        for label, start in ((1, 0.97), (0, 0.3)):
            for j in range(10):
                heavy = {i: (good[i] if label else 1 - good[i]) for i, (_, v) in cast.items() if v[j]}
                agree = sum(w for i, w in heavy.items() if cast[i][1][j] == 2 * label - 1)
                value = (agree + start * 10) / (sum(heavy.values()) + 10)
                new[label][j] = min(max(value, 0.9), 0.999) if label else min(max(value, 1.05 - new[1][j]), 0.99)
        right, share = new, min(max((sum(good.values()) + 8) / (len(cast) + 10), 0.05), 0.95)
    found = {r.doc_id: r for r in quality.judged(documents.where("length(coalesce(text, '')) < 20000")).collect()}
    assert found.keys() == cast.keys() and {r.kept for r in found.values()} == {True, False}
    for i, (failed, votes_) in cast.items():
        assert found[i].base_failed == failed and math.isclose(found[i].p_good, p_good(votes_), abs_tol=1e-6)
        assert found[i].kept == (not failed and p_good(votes_) >= 0.5)


def test_codes_of_distinct_words_are_those_of_each_word(odd_rows):
    """Words are coded without a step for each: head words by place, others by endings of any length."""
    draw = random.Random(8)
    words = [b"a", b"\xff", b"ab", b"\xff\x00", b"abc", b"hello", *(bytes(draw.choices(range(33, 256), k=draw.randint(1, 9))) for _ in range(3000))]
    listed = pa.array([b"", *words], pa.large_binary())
    for most in (1, 2, 3):
        assert maxent.crc_of_last(listed, most).tolist() == [zlib.crc32(w[-most:]) for w in [b"", *words]]
        assert maxent.crc_of_last(listed.slice(5, 70), most).tolist() == [zlib.crc32(w[-most:]) for w in words[4:74]]
    head = {maxent.END: 0, **{w: n for n, w in enumerate(dict.fromkeys(words[10:500]), 1)}}
    found = maxent.coded_tokens([*((r[1] or "").encode() for r in odd_rows), *[b"one hello", b"", b" of "]])
    head[found.words[0]] = len(head)
    codes = maxent.Codes(head).of(found)
    for word, code in zip((found.words[i] for i in found.index), codes, strict=True):
        at, tail = head.get(word), maxent.HEADS + maxent.tail_class(word)
        expected = (maxent.HEAD_WORDS + maxent.ending(word), tail, 0) if at is None else (at, at // maxent.WIDTH, at % maxent.WIDTH)
        assert maxent.unpacked(code) == expected


def test_word_counts_are_sent_in_parts(documents, monkeypatch):
    """Counts of a task that holds few words come in several parts, and add up to those of each word."""
    expected = Counter()
    for r in documents.select("doc_id", "text").collect():
        if maxent.is_training(r.doc_id):
            expected.update([*(r.text or "").encode().lower().split(), maxent.END])
    monkeypatch.setattr(maxent, "SLICE", 2000)
    monkeypatch.setattr(maxent, "HELD_WORDS", 500)
    assert {bytes(r.word): r.n for r in maxent.word_counts(documents).collect()} == expected
