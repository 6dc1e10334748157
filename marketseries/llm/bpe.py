"""Byte-pair encoding by a token automaton that is built merge by merge, and decoding by its arc labels."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketseries.llm.batches import keeps, worker_task
from marketseries.llm.words import SLICE, WordTable, flattened, slices

#: Arcs that a worker keeps, once looked up.
KEPT_ARCS = 1_000_000
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class TokenAutomaton:
    """Deterministic automaton over tokens that accepts just the token strings which the merges lead to.

    It starts as one state with an arc for every symbol. The gadget of a merge (u, v) -> w changes it so: the state
    after u loses its arc v; every state that still has the arc u gets an arc w, if v could follow u; the state after
    w is a copy of the state after v as it was. A state is kept as its gadgets, not as its arcs: which merge made a
    token, which state it is a copy of and since when, which arcs were taken away and when. An arc is looked up by
    following them once and is then an entry of the transition table.

    As every string has one accepted token string, the automaton reads a word from left to right and holds for each
    prefix the last token of the prefix's own token string.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.labels = {i: t for t, i in vocabulary.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.taken: dict[tuple[int, int], int] = {}
        self.table: dict[tuple[int, int], bool] = {}
        dead: set[int] = set()
        for k, (a, b) in enumerate(merges):
            u, v, w = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if w in self.born:
                raise ValueError(f"two merges make {a + b!r}")
            alive = u not in dead and v not in dead and self._arc(u, v, k)
            self.left[w], self.right[w], self.born[w] = u, v, k
            self.taken[u, v] = k
            if not alive:
                dead.add(w)
        self.suffix = suffix
        self.trie: dict = {}
        for token, i in vocabulary.items():
            if i not in dead:
                node = self.trie
                for symbol in self._symbols(token):
                    node = node.setdefault(symbol, {})
                node[None] = i

    def _symbols(self, token: str) -> list[str]:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            own = list(token[: -len(self.suffix)])
            own[-1] += self.suffix
            return own
        return list(token)

    def _arc(self, t: int, b: int, upto: int) -> bool:
        """Whether the state after ``t`` has the arc ``b`` once the first ``upto`` merges are built in."""
        born = self.born
        while True:
            if self.taken.get((t, b), upto) < upto:
                return False
            made_t, made_b = born.get(t, -1), born.get(b, -1)
            if made_b > made_t:
                b, upto = self.left[b], made_b + 1
            elif made_t > made_b:
                t, upto = self.right[t], made_t
            elif made_t < 0:
                return True
            else:
                t, b, upto = self.right[t], self.left[b], made_t

    def follows(self, t: int, b: int) -> bool:
        known = self.table.get((t, b))
        if known is None:
            if len(self.table) > KEPT_ARCS:
                self.table.clear()
            known = self.table[t, b] = self._arc(t, b, 1 << 60)
        return known

    def encode(self, word: str) -> list[int]:
        """Token string of one pre-split word of symbols; symbols that no token has are left out."""
        symbols = [s for s in self._symbols(word + self.suffix) if s in self.trie]
        n = len(symbols)
        last: list[int] = [-1] * (n + 1)
        before = [0] * (n + 1)
        follows = self.follows
        for i in range(n):
            own = last[i]
            if own < 0 and i:
                continue
            node = self.trie
            for j in range(i, n):
                node = node.get(symbols[j])
                if node is None:
                    break
                t = node.get(None)
                if t is not None and last[j + 1] < 0 and (not i or follows(own, t)):
                    last[j + 1], before[j + 1] = t, i
        out = []
        while n:
            out.append(last[n])
            n = before[n]
        return out[::-1]


def _byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 bytes: themselves where printable, else the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class WordBpe(WordTable):
    """Ids as the tokenizers library gives them for a byte-level vocabulary with word ends, lower case and NFC.

    White space only separates, so what stands between is encoded by itself and kept.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = TokenAutomaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", _WHITE)
        self.pattern = regex.compile(pattern)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.bytes = _byte_symbols()
        labels = self.automaton.labels | {i: t for t, i in self.special.items()}
        self.labels = pa.array([labels.get(i) for i in range(max(labels) + 1)], pa.string())
        self.words: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        known = self.words.get(word)
        if known is None:
            if len(self.words) > KEPT_ARCS // 4:
                self.words.clear()
            known = self.words[word] = self.automaton.encode("".join(self.bytes[b] for b in word.encode()))
        return known

    def _chunk(self, chunk: str) -> list[int]:
        if self.cut and self.cut.search(chunk):
            return [i for p in self.cut.split(chunk) for i in ([self.special[p]] if p in self.special else self._chunk(p))]
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk)
        # the library lower-cases character by character, without regard to the end of a word
        chunk = "".join(c.lower() for c in chunk) if "Σ" in chunk else chunk.lower()
        if chunk.isalpha():
            return self._word(chunk)
        return [i for w in self.pattern.findall(chunk) for i in self._word(w)]

    def encode_words(self, keys: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        return keys, *flattened([self._chunk(k) for k in keys])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) one after another, and where each text begins, with the end."""
        self.shrink()
        parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        ends = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        out, done = self.ids_at(self.places(coded.dictionary.to_pylist())[coded.indices.to_numpy()])
        return out, done[ends - ends[0]]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """Text of each run of ids: the labels of its arcs, joined by spaces."""
        labels = pc.take(self.labels, pa.array(ids))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), labels), " ")


_encoders: dict[str, WordBpe] = {}
keeps("bpe", _encoders.clear)


def word_bpe(path: str) -> WordBpe:
    if path not in _encoders:
        _encoders[path] = WordBpe(path)
    return _encoders[path]


def _slices(batches: Iterator[pa.RecordBatch], path: str):
    with worker_task("bpe"):
        enc = word_bpe(path)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), SLICE // 2):
                yield enc, batch.column("doc_id").slice(a, b - a), *enc.encode(texts.slice(a, b - a))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids of each row's text; null and empty texts have no ids, repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, ids, starts in _slices(batches, path):
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([keys, lists], names=["doc_id", "ids"])

    return _rows(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded text of rows (doc_id, ids); null ids are none, ids without a label are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_bpe(path)
        for batch in batches:
            lists = [[i for i in x or () if i is not None and 0 <= i < len(enc.labels)] for x in batch.column("ids").to_pylist()]
            flat, size = flattened(lists)
            known = pc.is_valid(pc.take(enc.labels, pa.array(flat))).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(size)]).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), enc.decode(flat[known], ends)], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row: text to ids to text in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for enc, keys, ids, starts in _slices(batches, path):
            raw = memoryview(np.append(ids, 0).astype("<u4")).cast("B")
            spans = list(zip(starts[:-1].tolist(), starts[1:].tolist()))
            texts = [hashlib.sha256(t.as_buffer()).hexdigest() for t in enc.decode(ids, starts)]
            own = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(np.diff(starts)), pa.array(own), pa.array(texts)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
