"""Exact encoding and decoding of whole texts with a lower-casing BPE vocabulary with word ends.

White space never belongs to a piece of this vocabulary and is dropped, so a text is the sequence of its words, each
encoded apart, and plain words are a sequence of runs that the vocabulary's pattern leaves unsplit; bounded caches hold what
was already seen. A run may still be very long. Such a run is encoded as a tree: leaves in parallel by the library, then neighbours are joined. At a
join, a window of the last pieces of the left side and the first of the right is encoded anew and grows until its first
and last pieces are those it had before; each pair of neighbouring pieces then stands in an exact encoding, which for
ranked merges makes the whole one exact. Only the run's last leaf carries the word end.

Defined cases: a null text counts as empty; an empty text, or white space alone, has no ids and the hash of the empty
string. Repeated rows and null doc_ids give one row each. Special-token strings inside a text become their ids, as the
library does by default.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from beaconlake.llm.common import raw_texts, texts, words
from beaconlake.llm.tokens import byte_alphabet

CACHED_WORDS = 400_000
#: Characters of an unsplit run from which on it is encoded as a tree, and of a leaf.
LONG_RUN = 4096
LEAF = 1024
#: Pieces on each side of a join that the first window takes.
WINDOW = 8


class TreeEncoder:
    """Encodes one unsplit run (already in the vocabulary's byte alphabet) by tree concatenation."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        spec |= {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.ending = Tokenizer.from_str(json.dumps(spec))
        spec["model"]["end_of_word_suffix"] = None
        self.open = Tokenizer.from_str(json.dumps(spec))
        vocabulary = spec["model"]["vocab"]
        self.piece = {number: piece for piece, number in vocabulary.items()}

    def _batch(self, parts: list[str], last_ends: bool) -> list[list[int]]:
        coder = self.open
        found = [e.ids for e in coder.encode_batch_fast(parts[:-1], add_special_tokens=False)]
        return [*found, self._one(parts[-1], last_ends)]

    def _one(self, part: str, ends: bool) -> list[int]:
        coder = self.ending if ends else self.open
        return coder.encode(part, add_special_tokens=False).ids

    def _text(self, ids: list[int], ends: bool) -> str:
        text = "".join(self.piece[i] for i in ids)
        return text.removesuffix(self.suffix) if ends and self.suffix else text

    def join(self, left: list[int], right: list[int], ends: bool) -> list[int]:
        """The encoding of both sides' text from the sides' encodings; ``ends``: the right side closes the run."""
        size = WINDOW
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            closes = ends and b == len(right)
            window = self._one(self._text(left[a:], False) + self._text(right[:b], closes), closes)
            left_agrees = a == 0 or window[0] == left[a]
            right_agrees = b == len(right) or window[-1] == right[b - 1]
            if left_agrees and right_agrees:
                return left[:a] + window + right[b:]
            size *= 2

    def encode(self, run: str) -> list[int]:
        level = self._batch([run[i : i + LEAF] for i in range(0, len(run), LEAF)], True)
        while len(level) > 1:
            last = len(level) - 1
            level = [
                self.join(level[i], level[i + 1], i + 1 == last) if i < last else level[i] for i in range(0, len(level), 2)
            ]
        return level[0]


#: ASCII without controls and the apostrophe (which opens contractions), and what encodes U+00C0 to U+00FF.
PLAIN = bytes([*range(0x09, 0x0E), *range(0x20, 0x27), *range(0x28, 0x7F), 0xC3, *range(0x80, 0xC0)])
#: The runs of a lower-cased plain text: letters, one digit, or marks.
RUNS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")
#: Number of ids, the ids in decimal, and the decoded text; the last two joined by blanks.
Coded = tuple[int, bytes, bytes]


class RunCoder(dict):
    """Codes of unsplit, normalised runs."""

    def __init__(self, model, alphabet: dict[int, str], tree: TreeEncoder, long_run: int):
        super().__init__()
        self.model, self.alphabet, self.tree, self.long_run = model, alphabet, tree, long_run

    def __missing__(self, run: bytes) -> Coded:
        if len(self) > CACHED_WORDS:
            self.clear()
        shown = run.decode("latin-1").translate(self.alphabet)
        if len(shown) < self.long_run:
            pieces = self.model.tokenize(shown)
            ids, values = [p.id for p in pieces], [p.value for p in pieces]
        else:
            ids = self.tree.encode(shown)
            values = [self.tree.piece[i] for i in ids]
        self[run] = found = (len(ids), " ".join(map(str, ids)).encode(), " ".join(values).encode())
        return found


class WordCoder(dict):
    """Codes of words of any kind; ``code`` gives those of a whole text."""

    def __init__(self, path: str, long_run: int = LONG_RUN):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tree = TreeEncoder(path)
        self.runs = RunCoder(self.tokenizer.model, byte_alphabet(), self.tree, long_run)
        self.long_run = long_run

    def _ids(self, word: str) -> list[int]:
        if len(word) < self.long_run or any(s in word for s in self.special):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        normal = self.tokenizer.normalizer.normalize_str(word)
        ids: list[int] = []
        for run, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            short = len(run) < self.long_run
            ids += self.tree._one(run, True) if short else self.tree.encode(run)
        return ids

    def __missing__(self, word: bytes) -> Coded:
        if len(self) > CACHED_WORDS // 4:
            self.clear()
        ids = self._ids(word.decode())
        decoded = self.tokenizer.decode(ids, skip_special_tokens=False)
        self[word] = found = (len(ids), " ".join(map(str, ids)).encode(), decoded.encode())
        return found

    def _plain(self, raw: bytes) -> bool:
        marks = raw.translate(None, PLAIN) or b"\xc3\x97" in raw or b"\xc3\xb7" in raw
        return not marks and not (b"<|" in raw and any(s.encode() in raw for s in self.special))

    def code(self, raw: bytes) -> Coded:
        """Number of ids, their decimal text, and the decoded text of a whole text.

        The vocabulary names no decoder, so the library's decode joins pieces by blanks, within words and between them.
        """
        if self._plain(raw):
            lowered = raw.lower() if raw.isascii() else raw.decode().lower().encode()
            parts = list(map(self.runs.__getitem__, RUNS.findall(lowered)))
        else:
            parts = [found for found in map(self.__getitem__, words(raw)) if found[0]]
        return sum([p[0] for p in parts]), b" ".join([p[1] for p in parts]), b" ".join([p[2] for p in parts])

    def ids(self, raw: bytes) -> list[int]:
        return [int(i) for i in self.code(raw)[1].split()]


@functools.lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    """One per worker process and vocabulary file."""
    return WordCoder(path)


OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer_path).code
        for batch in batches:
            rows = [code(raw) for raw in raw_texts(batch)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r[1]).hexdigest() for r in rows], pa.string()),
                pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
            ], schema=OUT)

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, ids`` (array<int>) of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = coder(tokenizer_path)
        for batch in batches:
            rows = [np.array(one.ids(raw), np.int32) for raw in raw_texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(pa.int32()))], schema=schema)

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")
