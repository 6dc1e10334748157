"""Repair of conversation structure: turns parsed by a weighted repair grammar in Chomsky normal form.

A symbol (p, q) of the grammar stands for rows whose repaired roles lead from state p to state q; its binary rules are
(p, r) -> (p, q) (q, r), its terminal rules the edits of one row. Cells over spans hold the least (cost, audit) of each
symbol. No audit of a span is the beginning of another one of equal cost, as what follows could only be insertions,
which cost; so the least cells of two neighbouring spans make the least cell of both, and cells of rows, of blocks of
rows and of whole partitions combine in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marketseries.llm.batches import arrow_rows, worker_task
from marketseries.session import cut_lineage

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Roles that may follow a state: the last role initial, or "0" at the start. Accepted are the start and "a".
FOLLOWS = {"0": "su", "s": "u", "u": "a", "a": "u"}
ROLES = {"u": "user", "a": "assistant"}
ENDS = (("0", "0"), ("0", "a"))
#: Rows of a block that is parsed at once, and cells of one that are combined at once.
BLOCK = 8
#: Rows with texts sent to a worker at once.
BATCH = 500
WHITE = r"[\x20\x09-\x0D]"

Cell = dict[tuple[str, str], tuple[int, str]]


def _reach() -> list[tuple[str, str]]:
    pairs = {(p, p) for p in FOLLOWS} | {(p, q) for p in FOLLOWS for q in FOLLOWS[p]}
    while more := {(p, r) for p, q in pairs for q2, r in pairs if q == q2} - pairs:
        pairs |= more
    return sorted(pairs)


SYMBOLS = _reach()
RULES = [(p, q, r) for p, q in SYMBOLS for q2, r in SYMBOLS if q == q2]


def joined(left: Cell, right: Cell, into: Cell) -> Cell:
    """Applies all binary rules to the cells of two neighbouring spans."""
    for p, q, r in RULES:
        if (p, q) in left and (q, r) in right:
            (a, x), (b, y) = left[p, q], right[q, r]
            held = into.get((p, r))
            if held is None or a + b < held[0] or (a + b == held[0] and x + y < held[1]):
                into[p, r] = (a + b, x + y)
    return into


def _insertions() -> Cell:
    """Cells of an empty span: what insertions alone lead to."""
    cell: Cell = {(p, p): (0, "") for p in FOLLOWS}
    cell |= {(p, q): (INSERT, "I") for p in FOLLOWS for q in FOLLOWS[p] if q in ROLES}
    while (more := joined(cell, cell, dict(cell))) != cell:
        cell = more
    return cell


INSERTIONS = _insertions()


@lru_cache(maxsize=None)
def row_cell(initial: str, fault: str) -> Cell:
    """Terminal rules for one row (fault: b blank, d duplicate, t truncated or none), closed under insertions."""
    cell: Cell = {(p, p): (DELETE, "D") for p in FOLLOWS}
    if fault not in ("b", "d"):
        more = TRUNCATED if fault == "t" else 0
        for p, q in ((p, q) for p in FOLLOWS for q in FOLLOWS[p]):
            if q == initial:
                cell[p, q] = (more, "K")
            elif q in ROLES:
                cell[p, q] = (REROLE + more, "R")
    return joined(joined(INSERTIONS, cell, {}), INSERTIONS, {})


def parse(cells: list[Cell]) -> Cell:
    """The cell of all spans together: cells of longer spans from those of shorter ones, over all places to split."""
    n = len(cells)
    table = {(i, i + 1): c for i, c in enumerate(cells)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            cell: Cell = {}
            for k in range(i + 1, i + length):
                joined(table[i, k], table[k, i + length], cell)
            table[i, i + length] = cell
    return table[0, n]


@lru_cache(maxsize=50_000)
def _block(rows: tuple[tuple[str, str], ...]) -> Cell:
    return parse([row_cell(*r) for r in rows])


def combined(cells: list[Cell]) -> Cell:
    while len(cells) > 1:
        cells = [parse(cells[i : i + BLOCK]) for i in range(0, len(cells), BLOCK)]
    return cells[0] if cells else INSERTIONS


def span_cell(rows: list[tuple[str, str]]) -> Cell:
    """The cell of any number of (initial, fault) rows, by blocks, blocks of blocks and so on."""
    return combined([_block(tuple(rows[i : i + BLOCK])) for i in range(0, len(rows), BLOCK)])


def cheapest(cell: Cell) -> tuple[int, str]:
    return min(cell[e] for e in ENDS if e in cell)


def _facts(rows: DataFrame) -> DataFrame:
    """One row for each different (conv_id, turn, role, text): its digest, role initial, own fault and copies."""
    text = F.col("text")
    first = F.substring("role", 1, 1)
    own = F.when(~text.rlike(r"[^\x20\x09-\x0D]"), "b").when(~text.rlike(rf"[.!?]{WHITE}*\z"), "t").otherwise("")
    rows = rows.select("conv_id", "turn", "digest", F.when(first.isin("s", "u", "a"), first).otherwise("x").alias("initial"), own.alias("fault"))
    return rows.groupBy("conv_id", "turn", "digest", "initial", "fault").agg(F.count(F.lit(1)).alias("copies"))


def _rows(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


_SUMS = ["blank", "duplicate", "truncated", "illegal", "distinct_turns"]


class Segment:
    """Consecutive rows of one conversation: counts, the roles and turns at both ends, the cell."""

    def __init__(self, first_key: tuple = (False, None, b"")):
        self.key, self.rows = first_key, []
        self.sums = dict.fromkeys(_SUMS, 0)
        self.first = self.last = ""
        self.low = self.high = None

    def add(self, turn: int | None, initial: str, fault: str, lead: bool, copies: int) -> None:
        fault = "d" if not lead and fault != "b" else fault
        rest = "b" if fault == "b" else "d"
        self.rows += [(initial, fault), *[(initial, rest)] * (copies - 1)]
        self._count(fault, 1)
        self._count(rest, copies - 1)
        self._meet(initial, initial, self._illegal(initial, initial) * (copies - 1))
        if turn is not None:
            self._turns(turn, turn, 1)

    def _count(self, fault: str, n: int) -> None:
        name = {"b": "blank", "d": "duplicate", "t": "truncated"}.get(fault)
        if name:
            self.sums[name] += n

    @staticmethod
    def _illegal(a: str, b: str) -> int:
        return a + b not in ("su", "ua", "au")

    def _meet(self, first: str, last: str, illegal: int) -> None:
        self.sums["illegal"] += illegal + (self._illegal(self.last, first) if self.last else 0)
        self.first, self.last = self.first or first, last

    def _turns(self, low: int, high: int, distinct: int) -> None:
        self.sums["distinct_turns"] += distinct - (self.high == low)
        self.low, self.high = low if self.low is None else self.low, high

    def cell(self) -> Cell:
        return span_cell(self.rows)

    def follow(self, row: dict) -> None:
        """Takes a later segment, as written, behind this one; cells are combined by the caller."""
        for name in ("blank", "duplicate", "truncated"):
            self.sums[name] += row[name]
        self._meet(row["first"], row["last"], row["illegal"])
        if row["low"] is not None:
            self._turns(row["low"], row["high"], row["distinct_turns"])

    def report(self, cell: Cell) -> dict:
        cost, audit = cheapest(cell)
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.sums["distinct_turns"], 2**63 - 1)
        return {"gaps": gaps, **{k: v for k, v in self.sums.items() if k != "distinct_turns"}, "cost": cost, "audit": audit}


def _schema(conv: T.DataType, fields: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(fields).fields])


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_PART = (
    "whole boolean, timed boolean, turn long, digest binary, first string, last string, low long, high long, blank long, duplicate long, "
    "truncated long, illegal long, distinct_turns long, costs array<long>, audits array<string>, gaps long, cost long, audit string"
)


def _segments(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Segments of a sorted partition; conversations inside it are whole, the first and last may go on elsewhere."""

    def written(conv, seg: Segment, whole: bool) -> dict:
        cell, sums = seg.cell(), seg.sums
        out = {"conv_id": conv, "whole": whole, **sums}
        if whole:
            return out | seg.report(cell)
        held = [cell.get(s) for s in SYMBOLS]
        return out | {
            "timed": seg.key[0], "turn": seg.key[1], "digest": seg.key[2], "first": seg.first, "last": seg.last, "low": seg.low,
            "high": seg.high, "costs": [h and h[0] for h in held], "audits": [h and h[1] for h in held],
        }

    with worker_task("conversations"):
        seg, now, ready, begun = None, None, [], 0
        for batch in batches:
            for conv, turn, digest, initial, fault, lead, copies in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "turn", "digest", "initial", "fault", "lead", "copies"))):
                if seg is None or conv != now:
                    if seg is not None:
                        ready.append(written(now, seg, begun > 1))
                    seg, now, begun = Segment((turn is not None, turn, digest)), conv, begun + 1
                seg.add(turn, initial, fault, lead, copies)
            if len(ready) >= 2000:
                yield pa.RecordBatch.from_pylist(ready, schema)
                ready = []
        if seg is not None:
            ready.append(written(now, seg, False))
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)


def _fold(part: pa.Table, schema: pa.Schema) -> pa.Table:
    """The report of a conversation whose segments lie in several partitions, in the order of its rows."""
    order = sorted(part.to_pylist(), key=lambda r: (r["timed"], r["turn"] or 0, r["digest"]))
    seg, cells = Segment(), []
    for row in order:
        seg.follow(row)
        cells.append({s: (c, a) for s, c, a in zip(SYMBOLS, row["costs"], row["audits"]) if c is not None})
    return pa.Table.from_pylist([{"conv_id": order[0]["conv_id"], **seg.report(combined(cells))}], schema)


def conversation_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost and the audit of the cheapest repair.

    Rows (conv_id, turn, role, text) are taken by turn, nulls first, rows of one turn by the SHA-256 of role and text.
    A null role or text is one space, rows with a null conv_id are one conversation; other columns are not read. Rows
    are equal when these hashes are, whose collisions (2^-128 among as many rows as can be stored) are not looked for.
    Edits are those of the module; an empty table gives no rows.

    A conversation may be of any length: rows are dealt out by ranges of (conversation, turn), each partition parses
    its share, and only conversations that cross a border are combined, from one cell for each partition.
    """
    return _report(_rows(conversations))


def _report(rows: DataFrame) -> DataFrame:
    facts = cut_lineage(_facts(rows), "turns")
    when = F.struct(F.col("turn").isNotNull().alias("timed"), F.col("turn").alias("turn"))
    earliest = facts.groupBy(F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")).agg(F.min(when).alias("_at"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest")) & F.col("turn").eqNullSafe(F.col("_at.turn"))
    facts = facts.join(earliest, same, "left").select(*facts.columns, F.col("_digest").isNotNull().alias("lead"))
    facts = facts.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")
    conv = rows.schema["conv_id"].dataType
    schema = _schema(conv, _PART)
    arrow = to_arrow_schema(schema)
    parts = cut_lineage(facts.mapInArrow(lambda batches: _segments(batches, arrow), schema), "segments")
    columns = ["conv_id", *T.StructType.fromDDL(_REPORT).names]
    report = _schema(conv, _REPORT)
    arrow_report = to_arrow_schema(report)
    over = parts.filter("not whole").groupBy("conv_id").applyInArrow(lambda part: _fold(part, arrow_report), report)
    return parts.filter("whole").select(columns).unionByName(over.select(columns))


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Repaired rows (conv_id, turn, role, text) of a sorted partition in which audits stand before their rows.

    Yields (conv_id, None, None, None) at the beginning of each conversation.
    """
    audit, at, state, now = "", 0, "0", None

    def insertions():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, "a" if state == "u" else "u"
            yield now, None, ROLES[state], ""

    for batch in batches:
        for conv, kind, turn, role, text, plan in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "audit"))):
            if kind == 0:
                yield from insertions()
                audit, at, state, now = plan, 0, "0", conv
                yield conv, None, None, None
                continue
            yield from insertions()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            if edit == "R":
                role = ROLES["a" if state == "u" else "u"]
            state = role[0]
            yield conv, turn, role, text
    yield from insertions()


def _digests(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    with worker_task("conversations"):
        keys, shas, sha, empty = [], [], None, True
        for conv, _, role, text in _walk(batches):
            if role is None:
                if sha:
                    shas.append(sha.hexdigest())
                    if len(shas) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(keys, schema[0].type), pa.array(shas)], schema=schema)
                        keys, shas = [], []
                keys.append(conv)
                sha, empty = hashlib.sha256(), True
                continue
            sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
        if sha:
            shas.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(keys, schema[0].type), pa.array(shas)], schema=schema)


def _repaired(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    with worker_task("conversations"):
        place, ready = 0, []
        for conv, turn, role, text in _walk(batches):
            if role is None:
                place = 0
                continue
            ready.append({"conv_id": conv, "place": place, "turn": turn, "role": role, "text": text})
            place += 1
            if len(ready) >= BATCH:
                yield pa.RecordBatch.from_pylist(ready, schema)
                ready = []
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)


def _in_order(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Audits and rows of a conversation in one partition, sorted by Spark, so that a worker reads them as a stream."""
    audits = report.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(b"").alias("digest"),
                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    rows = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "digest", "role", "text", F.lit(None).cast("string").alias("audit"))
    both = audits.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")
    return both.drop("digest")


def repaired_rows(conversations: DataFrame, report: DataFrame) -> DataFrame:
    """The conversations after the edits of their audits: conv_id, place (from 0), turn (null if inserted), role, text."""
    schema = _schema(conversations.schema["conv_id"].dataType, "place long, turn long, role string, text string")
    arrow = to_arrow_schema(schema)
    with arrow_rows(conversations.sparkSession, BATCH):
        out = _in_order(_rows(conversations), report).mapInArrow(lambda batches: _repaired(batches, arrow), schema)
        return cut_lineage(out, "repaired")


def repaired_digests(conversations: DataFrame, report: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired ``role:text`` joined by line breaks.

    A hash runs over all its text in order, so one task reads a conversation from end to end; it holds its audit and
    one batch of rows.
    """
    schema = _schema(conversations.schema["conv_id"].dataType, "repaired_sha256 string")
    arrow = to_arrow_schema(schema)
    with arrow_rows(conversations.sparkSession, BATCH):
        out = _in_order(_rows(conversations), report).mapInArrow(lambda batches: _digests(batches, arrow), schema)
        return cut_lineage(out, "digests")
