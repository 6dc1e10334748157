"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marketseries.llm.batches import keeps, worker_task

#: Texts that are not cut at spaces: a space within or at the end of a run of white space, rare white space, NUL.
_WHOLE = (
    r"[ \t\n\r\f] [ \t\n\r\f]|[ \t\n\r\f] $"
    r"|[\x{00}\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
#: Words a worker keeps; beyond it those are kept that came again.
KEPT_WORDS = 500_000
#: Bytes of text encoded at once.
SLICE = 2_000_000

#: Kinds of bytes: others, ASCII punctuation, white space, ASCII letters, those that end a longer character.
_MARK, _WHITE, _LETTER, _LATER = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = _MARK
_KIND[[9, 10, 12, 13, 32]] = _WHITE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[128:192] = _LATER

_encoders: dict[str, "WordEncoder"] = {}
keeps("words", _encoders.clear)


class WordTable:
    """Ids of the words that a worker has met, in a few flat arrays; subclasses encode new words."""

    def __init__(self) -> None:
        self._clear()

    def encode_words(self, keys: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The keys in some order, their ids one after another, and the number of ids of each."""
        raise NotImplementedError

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin, self.size, self.hits = (np.zeros(1 << 16, np.int32) for _ in range(3))
        self.used = 0

    def shrink(self) -> None:
        """Beyond the limit, keeps the words that came more than once."""
        n = len(self.known)
        if n <= KEPT_WORDS:
            return
        again = self.hits[:n] > 1
        if again.sum() > n // 2:
            return self._clear()
        words = [w for w, more in zip(self.known, again.tolist()) if more]
        begin, size, flat, hits = self.begin[:n][again], self.size[:n][again], self.flat, self.hits[:n][again]
        done = np.cumsum(size) - size
        self._clear()
        self.flat = flat[np.repeat(begin - done, size) + np.arange(size.sum())]
        self.begin, self.size, self.hits, self.used = done.astype(np.int32), size, hits // 2, len(self.flat)
        self.known = dict(zip(words, range(len(words))))

    def places(self, keys: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int32, len(keys))
        new = np.flatnonzero(at < 0)
        if len(new):
            missed = [keys[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(missed)))
            at[new] = list(map(self.known.__getitem__, missed))
        return at

    def _learn(self, keys: list[str]) -> None:
        keys, ids, size = self.encode_words(keys)
        n, total = len(self.known), len(ids)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(self.used + total, np.uint32)])
        while n + len(size) > len(self.size):
            self.begin, self.size, self.hits = (np.concatenate([x, np.zeros(n + len(size), np.int32)]) for x in (self.begin, self.size, self.hits))
        self.flat[self.used : self.used + total] = ids
        self.size[n : n + len(size)] = size
        self.begin[n : n + len(size)] = self.used + np.cumsum(size) - size
        self.used += total
        self.known.update(zip(keys, range(n, n + len(size))))

    def ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places one after another, and where each word begins, with the end."""
        self.hits[: len(self.known)] += np.minimum(np.bincount(at, minlength=len(self.known)), 1000).astype(np.int32)
        size = self.size[at]
        done = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        shift = (self.begin[at] - done[:-1]).astype(np.int32)
        return self.flat[np.repeat(shift, size) + np.arange(done[-1], dtype=np.int32)], done


def flattened(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)


class WordEncoder(WordTable):
    """Byte-level vocabularies cut a text before each space first, so what begins with a space can be encoded alone.

    Texts are also cut around a line break with no other white space beside it, and between a letter and ASCII
    punctuation, where the vocabularies cut as well: words then come again whatever closes them. Texts with other runs
    of white space or with the string of a special token go to the library whole.
    """

    def __init__(self, path: str):
        # Spark runs a worker for each core; the library's own threads would each hold memory of their own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        #: By the character that joins words: the ids that begin with it.
        self.opens = {c: np.zeros(max(vocabulary.values()) + 1, bool) for c in " \n"}
        for c, opens in self.opens.items():
            mark = self.tokenizer.pre_tokenizer.pre_tokenize_str(c + "a")[0][0][0]
            opens[[i for t, i in vocabulary.items() if t.startswith(mark)]] = True

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, keys: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Many words at once go to the library as one text: those with their space before them as they are, those
        without one on lines of their own, whose breaks' ids are dropped."""
        kinds: dict[str, list[str]] = {" ": [], "\n": [], "": []}
        for k in keys:
            if len(bare := k.split()) == 1 and bare[0] == k:
                kinds["\n"].append(k)
            else:
                kinds[" " if len(bare) == 1 and " " + bare[0] == k else ""].append(k)
        found = [flattened(self._library(kinds[""]))]
        for c in " \n":
            parts = [kinds[c][i : i + 500] for i in range(0, len(kinds[c]), 500)]
            for part, own in zip(parts, self._library(["".join(p) if c == " " else "\n" + "\n".join(p) for p in parts])):
                ids = np.array(own, np.uint32)
                opens = self.opens[c][ids]
                cuts = np.flatnonzero(opens)
                if len(cuts) != len(part):
                    found.append(flattened(self._library(part)))
                elif c == " ":
                    found.append((ids, np.diff(np.append(cuts, len(ids)))))
                else:
                    found.append((ids[~opens], np.diff(np.append(cuts, len(ids))) - 1))
        ids, size = (np.concatenate(x) for x in zip(*found))
        return kinds[""] + kinds[" "] + kinds["\n"], ids, size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text begins (one more entry than texts)."""
        self.shrink()
        texts = pc.fill_null(texts.cast(pa.string()), "")
        whole = pc.match_substring_regex(texts, _WHOLE)
        for s in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, s))
        order = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        words, ends = _words(pc.if_else(whole, "", texts) if len(order) else texts)
        coded = words.dictionary_encode()
        out, done = self.ids_at(self.places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()])
        starts = done[ends]
        if not len(order):
            return out, starts
        pieces = [out[a:b] for a, b in zip(starts[:-1], starts[1:])]
        for i, ids in zip(order, self._library(texts.take(pa.array(order)).to_pylist())):
            pieces[i] = np.array(ids, np.uint32)
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, with the space before them, and which of them each text begins with, with the end."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset)
    low, high = int(bounds[0]), int(bounds[-1])
    if low == high:
        return pa.array([], pa.string()), np.zeros(len(bounds), np.int64)
    raw = np.frombuffer(data, np.uint8, high - low, low)
    bounds = bounds.astype(np.int64) - low
    kind = _KIND[raw]
    cut = raw == 32
    # a mark after a letter: an ASCII one, or a two-byte one by its lead
    at = np.flatnonzero((kind[1:] == _MARK) & (kind[:-1] >= _LETTER)) + 1
    lead = raw[np.maximum(at - 2, 0)]
    latin = (at > 1) & (lead >= 0xC3) & (lead <= 0xC9) & ~((lead == 0xC3) & ((raw[at - 1] == 0x97) | (raw[at - 1] == 0xB7)))
    cut[at[(kind[at - 1] == _LETTER) | latin]] = True
    at = np.flatnonzero(raw[1:-1] == 10) + 1
    at = at[(kind[at - 1] != _WHITE) & (kind[at + 1] != _WHITE)]
    cut[at] = cut[at + 1] = True
    cut[bounds[bounds < high - low]] = True
    begin = np.flatnonzero(cut)
    places = pa.py_buffer(np.append(begin, high - low).astype(np.int32))
    return pa.StringArray.from_buffers(len(begin), places, pa.py_buffer(raw)), np.searchsorted(begin, bounds)


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` in total, at least one row each."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n + 1
    if begin < len(sizes):
        yield begin, len(sizes)


def text_slices(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    return slices([len(t) for t in texts], chars)


def encoded(batches: Iterable[pa.RecordBatch], key: str, path: str) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Keys, ids and starts of some documents at a time; columns are the key and ``text`` (null: empty)."""
    with worker_task("words"):
        enc = encoder(path)
        for batch in batches:
            keys, texts = batch.column(key).to_pylist(), batch.column("text")
            for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), SLICE):
                yield keys[a:b], *enc.encode(texts.slice(a, b - a))
