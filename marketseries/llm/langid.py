"""Language identification by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketseries.llm.batches import keeps, parts, worker_task
from marketseries.llm.words import text_slices

#: Labelled rows per language, characters of each, and characters in all that a language's automaton is built on.
TRAINING_ROWS, ROW_CHARS, REFERENCE_CHARS = 60, 2000, 30_000
#: A text is parsed in blocks of so many normalised characters, all blocks of a batch in step.
BLOCK = 2048
UNDETERMINED = "und"

_LETTER = np.array([chr(i).isalpha() for i in range(1 << 16)])


def normalised(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, with one space for each run of anything else."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = code >= 1 << 16
    letter = _LETTER[np.where(wide, 0, code)]
    if wide.any():
        letter[wide] = [chr(c).isalpha() for c in code[wide]]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] = letter[:1]
    return np.where(letter, code, 32)[keep]


class Automaton:
    """Suffix automaton of one reference as a table: an entry is the next state and how many phrases end before it."""

    def __init__(self, reference: np.ndarray):
        link, length, arcs = [-1], [0], [{}]
        last = 0
        for c in reference.tolist():
            new = len(link)
            length.append(length[last] + 1)
            link.append(0)
            arcs.append({})
            p = last
            while p >= 0 and c not in arcs[p]:
                arcs[p][c] = new
                p = link[p]
            if p >= 0:
                q = arcs[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(link)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    arcs.append(dict(arcs[q]))
                    while p >= 0 and arcs[p].get(c) == q:
                        arcs[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        letters = sorted(arcs[0])
        self.size = len(reference)
        self.width = len(letters) + 1
        # column 0 is every character that the reference lacks: it ends a phrase and is one itself
        table = np.zeros((len(link), self.width), np.int32)
        table[:, 0] = 2 << 24
        table[0, 0] = 1 << 24
        for k, c in enumerate(letters, 1):
            table[:, k] = arcs[0][c] | 1 << 24
        place = {c: k for k, c in enumerate(letters, 1)}
        for s, own in enumerate(arcs):
            for c, t in own.items():
                table[s, place[c]] = t
        self.table = table.ravel()
        self.narrow = np.zeros(1 << 16, np.uint8 if self.width < 256 else np.uint16)
        self.wide = {c: k for c, k in place.items() if c >= 1 << 16}
        for c, k in place.items():
            if c < 1 << 16:
                self.narrow[c] = k

    def columns(self, code: np.ndarray) -> np.ndarray:
        out = self.narrow[np.where(code < 1 << 16, code, 0)]
        for c, k in self.wide.items():
            out[code == c] = k
        return out

    def phrases(self, steps: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Phrases of each lane of ``steps`` (position, lane), of which the first ``live[t]`` lanes go on at step t."""
        state = np.zeros(steps.shape[1], np.int32)
        count = np.zeros(steps.shape[1], np.int32)
        for column, n in zip(steps, live.tolist()):
            entry = self.table[state[:n] * np.int32(self.width) + column[:n]]
            count[:n] += entry >> 24
            state[:n] = entry & 0xFFFFFF
        return count + (state > 0)


@lru_cache(maxsize=1)
def automata(references: tuple[str, ...]) -> list[Automaton]:
    return [Automaton(np.array(list(map(ord, r)), np.uint32)) for r in references]


keeps("language", automata.cache_clear)


def cross_entropies(texts: list[np.ndarray], machines: list[Automaton]) -> np.ndarray:
    """Phrases * log2(reference length) / characters of every normalised text, by language."""
    size = np.array([len(t) for t in texts])
    blocks = -(-size // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    length = np.minimum(BLOCK, size[owner] - nth * BLOCK)
    order = np.argsort(-length, kind="stable")
    lane = np.empty(len(order), np.int64)
    lane[order] = np.arange(len(order))
    code = np.concatenate([np.zeros(0, np.uint32), *texts])
    at = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    row, column = at % BLOCK, lane[np.repeat(np.cumsum(blocks) - blocks, size) + at // BLOCK]
    live = np.searchsorted(-np.sort(-length), 0) if not len(length) else np.searchsorted(-length[order], -np.arange(length.max()), "left")
    out = np.zeros((len(texts), len(machines)))
    for k, m in enumerate(machines):
        steps = np.zeros((int(length.max(initial=0)), len(owner)), m.narrow.dtype)
        steps[row, column] = m.columns(code)
        total = np.bincount(owner, m.phrases(steps, np.atleast_1d(live))[lane], len(texts))
        out[:, k] = total * math.log2(m.size + 1) / np.maximum(1, size)
    return out


def references(docs: DataFrame, training: str, rows: int = TRAINING_ROWS, chars: int = REFERENCE_CHARS) -> dict[str, str]:
    """Normalised reference text by language: the labelled rows with the least key hashes, at most ``chars`` each.

    This is the bounded sample that the automata are fitted on: ``rows`` rows of at most ``ROW_CHARS`` characters.
    """
    least = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    sample = docs.filter("lang is not null and text is not null and doc_id is not null").filter(training).select(
        F.col("lang").cast("string").alias("lang"), "doc_id", F.substring(F.col("text").cast("string"), 1, ROW_CHARS).alias("text"))
    sample = sample.withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= rows)
    found: dict[str, list[str]] = {}
    for r in sample.orderBy("lang", "_n").collect():
        found.setdefault(r["lang"], []).append("".join(map(chr, normalised(r["text"]))))
    return {lang: t for lang, x in found.items() if (t := " ".join(x)[:chars]).strip()}


def identify(docs: DataFrame, known: dict[str, str]) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to rows with ``text``, by the reference texts of :func:`references`.

    The language whose reference needs the fewest phrases, weighted by the logarithm of the reference's length, wins;
    ties go to the first name. The score is by how much of the second best's cross entropy the best is better (1 if
    there is one language only). ``und`` with score 0: null, no letters, or no language known. Columns of these names
    are replaced.
    """
    names = sorted(known)
    texts = tuple(known[n] for n in names)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.withColumn("text", F.col("text").cast("string")).select(*kept)
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with worker_task("language"):
            yield from predicted(batches)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = automata(texts)
        for batch in parts(batches):
            own = batch.column("text").to_pylist()
            lang, score = [UNDETERMINED] * len(own), [0.0] * len(own)
            for a, b in text_slices([t or "" for t in own], 3_000_000):
                norm = [normalised(t or "") for t in own[a:b]]
                rows = [i for i, t in enumerate(norm) if (t != 32).any()] if names else []
                if not rows:
                    continue
                cost = cross_entropies([norm[i] for i in rows], machines)
                best = cost.argmin(1)
                low = cost[np.arange(len(rows)), best]
                second = np.partition(cost, 1, axis=1)[:, 1] if len(names) > 1 else np.full(len(rows), np.inf)
                for i, k, s in zip(rows, best.tolist(), (1 - low / second).tolist()):
                    lang[a + i], score[a + i] = names[k], s
            out = [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=[*kept, "lang_pred", "score"])

    return docs.mapInArrow(predict, schema)
