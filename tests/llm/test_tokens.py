import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from beaconlake.llm import bpe, common, packing, token_files, tokens
from beaconlake.llm.queries import BYTE_BPE, WORD_BPE

PARTS = [" ", "  ", "\n", "a", "B", "'s", "é", "　", "\t", "1", "!", "\xa0", "\x1c", "<|endoftext|>", "ß", "́", "日", "\x00", "×", "É", " the", "of", "."]


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(3)
    return ["", " ", "a  b", *("".join(draw.choice(PARTS) for _ in range(draw.randint(1, 30))) for _ in range(3000))]


def test_word_by_word_equals_whole(odd_texts):
    library = Tokenizer.from_file(BYTE_BPE)
    found = tokens.WordEncoder(BYTE_BPE).encode(t.encode() for t in odd_texts)
    for text, ids in zip(odd_texts, found, strict=True):
        assert library.encode(text, add_special_tokens=False).ids == ids.tolist(), text


def test_a_small_cache_changes_nothing(odd_texts, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 4000)
    monkeypatch.setattr(tokens, "SLICE", 100)
    library = Tokenizer.from_file(BYTE_BPE)
    for text, ids in zip(odd_texts[:500], tokens.WordEncoder(BYTE_BPE).encode(t.encode() for t in odd_texts[:500])):
        assert library.encode(text, add_special_tokens=False).ids == ids.tolist()


def test_bpe_equals_the_library(odd_texts):
    library, coder = Tokenizer.from_file(WORD_BPE), bpe.WordCoder(WORD_BPE)
    for text in odd_texts:
        ids = library.encode(text, add_special_tokens=False).ids
        expected = (len(ids), " ".join(map(str, ids)).encode(), library.decode(ids, skip_special_tokens=False).encode())
        assert coder.code(text.encode()) == expected, text


def test_trees_equal_the_library(monkeypatch):
    monkeypatch.setattr(bpe, "LEAF", 7)
    monkeypatch.setattr(bpe, "WINDOW", 1)
    draw = random.Random(4)
    library, coder = Tokenizer.from_file(WORD_BPE), bpe.WordCoder(WORD_BPE, long_run=40)
    runs = ["".join(draw.choice(["the", "in", "ation", "x", "é", "ing", "aa", "日", "Zz", "!?"]) for _ in range(draw.randint(20, 300))) for _ in range(500)]
    for run in [*runs, *("a" * n for n in range(38, 200, 7)), "é" * 333]:
        assert coder.ids(run.encode()) == library.encode(run, add_special_tokens=False).ids


def expected_bpe(rows):
    library = Tokenizer.from_file(WORD_BPE)
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out, key=str)


def test_encode_decode_documents(odd, odd_rows, empty):
    assert sorted((tuple(r) for r in bpe.encode_decode(odd, WORD_BPE).collect()), key=str) == expected_bpe([r[:2] for r in odd_rows])
    assert bpe.encode_decode(empty, WORD_BPE).count() == 0
    row = bpe.encode(odd.where("doc_id = 9"), WORD_BPE).first()
    assert row.ids == Tokenizer.from_file(WORD_BPE).encode("One", add_special_tokens=False).ids


def test_token_files(odd, odd_rows, empty, tmp_path):
    library = Tokenizer.from_file(BYTE_BPE)
    found = [tuple(r) for r in token_files.round_trip(odd, BYTE_BPE, end_id=0).orderBy("start").collect()]
    ids = [r[0] for r in found]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    at = 0
    texts = {}
    for doc_id, text, *_ in odd_rows:
        texts.setdefault(doc_id, []).append(library.encode(text or "", add_special_tokens=False).ids + [0])
    for doc_id, start, n, crc in found:
        match = next(t for t in texts[doc_id] if zlib.crc32(np.array(t, "<u4").tobytes()) == crc)
        texts[doc_id].remove(match)
        assert start == at and n == len(match)
        at += n
    assert not any(texts.values())
    assert token_files.round_trip(empty, BYTE_BPE, end_id=0).count() == 0


def test_token_files_are_flat(odd, spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    token_files.write_token_files(odd, BYTE_BPE, 0, folder, partitions=3)
    parts = spark.read.parquet(f"{folder}/parts").orderBy("part").collect()
    assert [p.base for p in parts] == [sum(q.ids for q in parts[:n]) for n in range(len(parts))]
    for part in parts:
        ids, offsets, docs = token_files.mapped(f"{tmp_path}/out", part.part, part.dtype)
        assert ids.dtype == np.uint16 and len(ids) == part.ids == offsets[-1] and len(docs) == part.docs == len(offsets) - 1


def check_packing(rows, docs, size):
    library = Tokenizer.from_file(BYTE_BPE)
    used = {}
    for r in rows:
        assert 0 < r.length <= size
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    expected = []
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % size + 1
        starts = [0, *range(first, len(ids), size)]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            expected.append((doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(expected, key=str)
    return len(used), -(-sum(r.length for r in rows) // size)


def test_packing(odd, odd_rows, empty):
    check_packing(packing.pack(odd, BYTE_BPE, 2, 64).collect(), [r[:2] for r in odd_rows], 64)
    assert packing.pack(empty, BYTE_BPE, 2).count() == 0


def test_packing_is_tight(documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    used, least = check_packing(packing.pack(documents, BYTE_BPE, 2, 1024).collect(), docs, 1024)
    assert used <= 1.05 * least + 1


def test_plans_place_every_piece():
    draw = np.random.default_rng(2)
    for n in (1, 50, 3000):
        found = np.bincount(np.clip(draw.lognormal(5, 1, n).astype(int), 1, 256), minlength=257)
        rows = packing.plan(found, 256)
        placed = np.zeros(257, int)
        for length, a, b, _, offset in rows:
            placed[length] += b - a
            assert offset + length <= 256
        assert (placed == found).all()


def test_forgotten_words_are_learned_again(documents, monkeypatch):
    """With hardly any memory words are forgotten in every slice; ids stay those of the library."""
    monkeypatch.setattr(tokens, "REMEMBERED", 100_000)
    monkeypatch.setattr(tokens, "SLICE", 20_000)
    encoder = tokens.WordEncoder(BYTE_BPE)
    library = Tokenizer.from_file(BYTE_BPE)
    texts = [r.text or "" for r in documents.limit(120).collect()] + ["", " ", "  a", "a  ", " b\n c", "x" * 300, "don't stop-me! now?", "été 中文 a"]
    for found, text in zip(encoder.encode(t.encode() for t in texts), texts, strict=True):
        assert found.tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.size < 2 * 100_000 + 20_000 * 100 and encoder.uses[: encoder.n_words].max() > 0


def test_word_hashes_tell_words_apart():
    draw = random.Random(4)
    words = [b"", *{bytes(draw.choice(b"ab") for _ in range(draw.randrange(1, 14))) for _ in range(20_000)}]
    words += [b"a" * n for n in range(14, 400)] + [b"a" * 64 + b"b" + b"a" * n for n in range(200)]
    for k in range(2):
        both = np.concatenate([tokens.word_hashes(words)[k], tokens.word_hashes(words, opening=True)[k]])
        assert len(np.unique(both)) == 2 * len(words)
        alone = np.array([tokens.word_hashes([w])[k][0] for w in words[::50]])
        assert (alone == both[: len(words)][::50]).all()


def test_tasks_of_other_kinds_let_go_of_the_vocabulary():
    idle = common.tidy(lambda batches: batches)
    encoding = common.tidy(lambda batches: batches, "encoder")
    first = tokens.encoder(BYTE_BPE)
    assert list(encoding(iter([1, 2]))) == [1, 2]
    assert tokens.encoder(BYTE_BPE) is first  # held for the next task that encodes
    assert list(idle(iter([3]))) == [3]
    assert tokens.encoder.cache_info().currsize == 0


def test_known_words_are_looked_up_once(monkeypatch):
    """A slice that brings one new word, with a mark and without, looks its other words up once, and each hash is taken once."""
    monkeypatch.setattr(tokens, "SLICE", 1)
    encoder, looked, hashed = tokens.WordEncoder(BYTE_BPE), [], []
    numbers, hashes = tokens.WordEncoder._numbers, tokens._hashed
    monkeypatch.setattr(tokens.WordEncoder, "_numbers", lambda self, h: (looked.append(len(h[0])), numbers(self, h))[1])
    monkeypatch.setattr(tokens, "_hashed", lambda words, first=0: (hashed.append(len(words)), hashes(words, first))[1])
    known = "It was " + " ".join(f"word{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(600))
    texts = [known, f"{known} other, other; wordaa, wordaa other", f"{known}, more"]
    library = Tokenizer.from_file(BYTE_BPE)
    for n, (text, ids) in enumerate(zip(texts, encoder.encode(t.encode() for t in texts), strict=True)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        if n:
            assert sum(looked) < 650 and sum(hashed) < 650
        looked.clear()
        hashed.clear()
