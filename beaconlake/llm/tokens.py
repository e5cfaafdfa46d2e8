"""Byte-level BPE ids of whole texts, encoded by the tokenizers library word by word with a bounded cache.

The vocabulary's pattern always starts a new piece at a blank that is followed by a visible character: the blank opens the
next piece, and white space before it is a piece that ends there whether or not more text follows. So a text may be cut at
every such blank, its parts encoded apart, and the ids joined. Special-token strings hold no blank, so each lies in one part.
For the same reason many parts may be encoded by one library call on their joined text; the ids' byte lengths tell them apart.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from beaconlake.llm.common import hold
from beaconlake.llm.repeats import mixed

#: Bytes that the words a task remembers may take; when they do, the half that was met most often stays.
REMEMBERED = 64 << 20
#: What a remembered word takes besides its ids: two hashes, places, length, uses, and room to grow.
ENTRY = 72
#: Bytes of text whose words are looked up together.
SLICE = 1 << 20
#: A blank that is not followed by a certainly visible character: another blank, ASCII or wider white space, or the end.
ODD_BLANK = re.compile(rb" (?![!-~\xc3-\xcf])")
#: Letters (ASCII, or those among U+00C0 to U+00FF) and then ASCII marks, not led by an apostrophe as contractions are:
#: the pattern cuts between the two whatever else stands around them.
MARKED = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]*)")
MARKS = frozenset(bytes([b]) for b in range(0x21, 0x7F) if not chr(b).isalnum())
OPENS = re.compile(rb" (?=[!-~\xc3-\xcf])")


class WordEncoder:
    """``encode`` gives the ids of whole texts, equal to the library's encode of each with add_special_tokens=False."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # a piece of this vocabulary has one character for each byte; special tokens stand for their own text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        self.n_bytes[list(vocabulary.values())] = [len(piece) for piece in vocabulary]
        for number, special in self.tokenizer.get_added_tokens_decoder().items():
            self.n_bytes[number] = len(special.content.encode())
        # words are known by 128 bits of hash, and numbered as they come; those that open a text have a blank before them,
        # which no word holds
        self.keys, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.checks, self.starts, self.lengths, self.uses = (np.zeros(1 << 14, t) for t in (np.uint64, np.int64, np.int32, np.int64))
        self.flat = np.zeros(1 << 16, "<u4")
        self.n_words, self.n_flat = 0, 0

    @property
    def size(self) -> int:
        return ENTRY * self.n_words + 4 * self.n_flat

    def _ids(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, "<u4")

    def _add(self, hashes: tuple[np.ndarray, np.ndarray], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Remember new words, whose ids stand one after another."""
        first, end = self.n_words, self.n_words + len(lengths)
        self.flat = _room(self.flat, self.n_flat + len(ids))
        self.checks, self.starts, self.lengths, self.uses = (_room(x, end) for x in (self.checks, self.starts, self.lengths, self.uses))
        self.flat[self.n_flat : self.n_flat + len(ids)] = ids
        self.starts[first:end] = self.n_flat + np.cumsum(lengths) - lengths
        self.lengths[first:end], self.checks[first:end], self.uses[first:end] = lengths, hashes[1], 0
        at = np.argsort(hashes[0], kind="stable")
        where = np.searchsorted(self.keys, hashes[0][at])
        self.keys = np.insert(self.keys, where, hashes[0][at])
        self.order = np.insert(self.order, where, (first + at).astype(np.int32))
        self.n_words, self.n_flat = end, self.n_flat + len(ids)

    def _numbers(self, hashes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Number of each word, -1 for those not known."""
        if not self.n_words:
            return np.full(len(hashes[0]), -1)
        ascending = np.argsort(hashes[0])  # a search in order finds what it needs in the processor's cache
        at = np.empty(len(ascending), np.int64)
        at[ascending] = np.searchsorted(self.keys, hashes[0][ascending])
        at = np.minimum(at, self.n_words - 1)
        found = self.order[at].astype(np.int64)
        return np.where((self.keys[at] == hashes[0]) & (self.checks[found] == hashes[1]), found, -1)

    def _forget(self) -> None:
        kept = np.sort(np.argsort(-self.uses[: self.n_words], kind="stable")[: self.n_words // 2])
        keys = np.empty(self.n_words, np.uint64)
        keys[self.order] = self.keys
        hashes, lengths, uses = (keys[kept], self.checks[kept]), self.lengths[kept], self.uses[kept]
        ids = self.flat[_gather(self.starts[kept], lengths)]
        self.keys, self.order, self.n_words, self.n_flat = self.keys[:0], self.order[:0], 0, 0
        self._add(hashes, ids, lengths)
        self.uses[: len(kept)] = uses // 2

    def _learn(self, words: list[bytes], hashes: tuple[np.ndarray, np.ndarray]) -> None:
        """Words that are not known yet, each once, and their hashes."""
        at, plain, stems, marks = [], [], [], []
        for i, word in enumerate(words):
            if word[-1:] in MARKS and (found := MARKED.fullmatch(word)):
                at.append(i)
                stems.append(found[1])
                marks.append(found[2])
            else:
                plain.append(i)
        fresh, own = [words[i] for i in plain], [h[plain] for h in hashes]
        if stems:
            place = {stem: n for n, stem in enumerate(dict.fromkeys(stems))}
            distinct = list(place)
            of_stems = word_hashes(distinct)
            listed = set(fresh)
            new = [i for i in np.flatnonzero(self._numbers(of_stems) < 0).tolist() if distinct[i] not in listed]
            fresh += [distinct[i] for i in new]
            own = [np.concatenate([a, b[new]]) for a, b in zip(own, of_stems)]
        if fresh:
            ids = self._ids(b" " + b" ".join(fresh))
            ends = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum([len(w) + 1 for w in fresh])) + 1
            self._add(tuple(own), ids, np.diff(ends, prepend=0))
        if stems:
            left = self._numbers(of_stems)[[place[stem] for stem in stems]]
            parts = np.stack([left, self._open(marks)], axis=1)
            ids = self.flat[_gather(self.starts[parts.ravel()], self.lengths[parts.ravel()].astype(np.int64))]
            self._add(tuple(h[at] for h in hashes), ids, self.lengths[parts].sum(axis=1))

    def _open(self, parts: list[bytes]) -> np.ndarray:
        """Numbers of first parts of texts, which no blank opens."""
        place = {part: n for n, part in enumerate(dict.fromkeys(parts))}
        fresh = list(place)
        hashes = word_hashes(fresh, opening=True)
        number = self._numbers(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            ids = [self._ids(fresh[i]) for i in new.tolist()]
            first = self.n_words
            self._add(tuple(h[new] for h in hashes), np.concatenate(ids), np.array([len(i) for i in ids]))
            number[new] = first + np.arange(len(new))
        return number[[place[part] for part in parts]]

    def _slice(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not texts:
            return
        if self.size > REMEMBERED:
            self._forget()
        odd = [bool(ODD_BLANK.search(raw)) for raw in texts]
        even = pc.split_pattern(pa.array([raw for raw, o in zip(texts, odd) if not o], pa.large_binary()), b" ")
        split = [OPENS.split(raw) for raw, o in zip(texts, odd) if o]
        # texts cut at every blank, then the others
        values = pa.concat_arrays([even.flatten(), pa.array([p for parts in split for p in parts], pa.large_binary())])
        counts = np.concatenate([even.value_lengths().to_numpy(zero_copy_only=False), np.array([len(p) for p in split], np.int64)]).astype(np.int64)
        firsts = np.cumsum(counts) - counts
        coded = values.dictionary_encode()
        place, words = coded.indices.to_numpy(), coded.dictionary
        openers = _listed(words.take(pa.array(place[firsts])))
        inside = np.ones(len(place), bool)
        inside[firsts] = False
        met = np.bincount(place[inside], minlength=len(words)) > 0
        hashes = _hashed(words)
        number = self._numbers(hashes)
        new = np.flatnonzero(met & (number < 0))
        if len(new):
            own = tuple(h[new] for h in hashes)
            self._learn(_listed(words.take(pa.array(new))), own)
            number[new] = self._numbers(own)
        opening = self._open(openers)
        number = np.maximum(number, 0)[place]
        number[firsts] = opening
        self.uses[: self.n_words] += np.bincount(number, minlength=self.n_words)
        lengths = self.lengths[number].astype(np.int64)
        ids = self.flat[_gather(self.starts[number], lengths)]
        ends = np.cumsum(lengths)[firsts + counts - 1]
        found = np.split(ids, ends[:-1])
        even_ids, odd_ids = iter(found[: len(texts) - sum(odd)]), iter(found[len(texts) - sum(odd) :])
        for o in odd:
            yield next(odd_ids if o else even_ids)

    def encode(self, texts: Iterator[bytes]) -> Iterator[np.ndarray]:
        held, size = [], 0
        for raw in texts:
            held.append(raw)
            size += len(raw)
            if size > SLICE:
                yield from self._slice(held)
                held, size = [], 0
        yield from self._slice(held)


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in such vocabularies: itself if printable in Latin-1, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


_draw = np.random.default_rng(21)
_values = _draw.integers(1, 2**63, (2, 256), dtype=np.uint64) | np.uint64(1)
_factors = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Long words are hashed in pieces of so many bytes.
PIECE = 64
_powers = np.array([[pow(f, k, 1 << 64) for k in range(PIECE)] for f in _factors], np.uint64)


def _hashed(words: pa.Array, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of 64 bits of each item of a large binary array."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
    pieces = -(-lengths // PIECE)
    heads = np.cumsum(pieces) - pieces
    at = _gather(np.zeros(len(words), np.int64), pieces)  # piece of its word
    piece_starts = np.repeat(starts, pieces) + PIECE * at
    within = np.arange(len(raw)) - np.repeat(piece_starts, np.minimum(PIECE, np.repeat(lengths, pieces) - PIECE * at))
    out = []
    for k in range(2):
        total = (lengths.astype(np.uint64) + np.uint64(first)) * _values[k, 0]
        if len(raw):
            sums = np.add.reduceat(_values[k][raw] * _powers[k][within], piece_starts)
            sums = mixed(sums + (at.astype(np.uint64) + np.uint64(1)) * _values[k, 1])
            full = np.flatnonzero(pieces > 0)
            total[full] += np.add.reduceat(sums, heads[full])
        out.append(mixed(total))
    return out[0], out[1]


def _listed(words: pa.Array) -> list[bytes]:
    """The items of a binary array; ``to_pylist`` makes an object for each on the way."""
    return words.to_numpy(zero_copy_only=False).tolist()


def word_hashes(words: list[bytes], opening: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words; ``opening`` those of parts that open a text."""
    return _hashed(pa.array(words, pa.large_binary()), first=1 << 40 if opening else 0)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a longer copy of it that has room for ``size`` items."""
    if size <= len(array):
        return array
    longer = np.zeros(max(size, 2 * len(array)), array.dtype)
    longer[: len(array)] = array
    return longer


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of ranges, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One per worker process and vocabulary file."""
    return WordEncoder(path)


hold("encoder", encoder.cache_clear)
