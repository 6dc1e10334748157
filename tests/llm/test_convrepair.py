"""Conversation repair against a shortest path over the rows and, on short conversations, all edit strings."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from marketseries.llm import convrepair
from marketseries.llm.queries import damaged, op12_conversation_repair

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def faults(rows):
    """(initial, fault) of rows in order, by the rules of the contract."""
    seen, out = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def cheapest(rows):
    """Least (cost, audit) and the repaired roles by a search over (row, last role), plain and left to right."""
    follows = {"0": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "0")], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in "0a":
            return cost, audit
        moves = [(3, "I", i, q) for q in follows[state] if q in "ua"]
        if i < len(rows):
            initial, fault = rows[i]
            moves.append((4, "D", i + 1, state))
            if fault not in ("b", "d"):
                more = 3 if fault == "t" else 0
                moves += [(more, "K", i + 1, q) for q in follows[state] if q == initial]
                moves += [(3 + more, "R", i + 1, q) for q in follows[state] if q in "ua"]
        for c, e, j, q in moves:
            heapq.heappush(heap, (cost + c, audit + e, j, q))


def repaired(rows, audit):
    out, at, state = [], 0, "0"
    for e in audit:
        if e == "D":
            at += 1
            continue
        role = {"u": "assistant"}.get(state, "user") if e in "IR" else rows[at][1]
        turn, text = (None, "") if e == "I" else (rows[at][0], rows[at][2])
        at += e != "I"
        state = role[0]
        out.append((turn, role, text))
    return out


def ordered(rows):
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    sha = lambda r, x: hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, sha(r[1], r[2])))


def by_loop(rows):
    rows = ordered(rows)
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    n = [sum(f == k for _, f in found) for k in "bdt"]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(found)
    text = "\n".join(f"{r}:{x}" for _, r, x in repaired(rows, audit))
    return (gaps, *n, illegal, cost, audit), hashlib.sha256(text.encode()).hexdigest()


def test_all_edit_strings():
    kinds = [(i, f) for i in "suax" for f in ("", "t", "b")]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n) if n < 3 else random.Random(1).sample(list(itertools.product(kinds, repeat=3)), 40):
            best = None
            for m in range(n, n + 4):
                for audit in itertools.product("DIKR", repeat=m):
                    if sum(e != "I" for e in audit) != n:
                        continue
                    cost, state, at, good = 0, "0", 0, True
                    for e in audit:
                        initial, fault = rows[at] if e != "I" else ("", "")
                        at += e != "I"
                        if e == "D":
                            cost += 4
                            continue
                        nxt = initial if e == "K" else "a" if state == "u" else "u"
                        good = good and fault != "b" and nxt in {"0": "su", "s": "u", "u": "a", "a": "u"}[state] and nxt != ""
                        if not good:
                            break
                        cost += (0 if e == "K" else 3) + (3 if fault == "t" else 0)
                        state = nxt
                    if good and state in "0a":
                        best = min(best or (10**9, ""), (cost, "".join(audit)))
            assert convrepair.cheapest(convrepair.span_cell(list(rows))) == best == cheapest(rows)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 300])
def test_long_conversations(n):
    rnd = random.Random(n)
    for _ in range(6):
        rows = [(rnd.choice("ssuuuaaax"), rnd.choice(["", "", "", "t", "b", "d"])) for _ in range(n)]
        assert convrepair.cheapest(convrepair.span_cell(rows)) == cheapest(rows)


def check(spark, table, parts=5):
    """Operator against the loop; ``table`` maps a conversation to its rows (turn, role, text)."""
    given = [(c, t, r, x, "o", 1, b"d", "f") for c, rows in table.items() for t, r, x in rows]
    random.Random(0).shuffle(given)
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string, audit string, kind int, digest binary, fault string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = convrepair.conversation_report(df.repartition(parts)).persist()
        got = {r["conv_id"]: tuple(r[c] for c in COUNTS) for r in report.collect()}
        hashes = dict(map(tuple, convrepair.repaired_digests(df, report).collect()))
        rows = {}
        for r in convrepair.repaired_rows(df, report).orderBy("conv_id", "place").collect():
            rows.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wanted = {c: by_loop(x) for c, x in table.items()}
    assert got == {c: w[0] for c, w in wanted.items()}
    assert hashes == {c: w[1] for c, w in wanted.items()}
    assert {c: rows.get(c, []) for c in table} == {c: repaired(ordered(x), wanted[c][0][-1]) for c, x in table.items()}


def test_odd_rows(spark):
    check(spark, {
        1: [(0, "user", "a."), (0, "user", "a."), (None, "user", "a."), (3, None, None), (5, "assistant", "b"), (9, "", "c!")],
        2: [(None, None, None)], 3: [(4, "system", "only.")], 4: [(2, "assistant", "x?  \n"), (2, "user", "y")],
        None: [(1, "user", "q."), (2, "assistant", "w" * 300_000 + ".")], 5: [(1, "tool", ""), (2, "SYSTEM", "z.")],
        6: [(-(2**62), "user", "é."), (2**62, "assistant", "é。")], 7: [(1, "system", "s."), (2, "system", "s2.")],
    })


def test_random_and_one_long_conversation(spark):
    rnd = random.Random(2)
    row = lambda t: (t, rnd.choice(["system", "user", "assistant", "user", "assistant", None]), rnd.choice(["a.", "b", " ", f"c{t}.", f"d{t}"]))
    table = {c: [row(rnd.choice([None, *range(6)])) for _ in range(rnd.randrange(1, 9))] for c in range(60)}
    table[60] = [row(rnd.choice([None, 2**60 + rnd.randrange(3000), rnd.randrange(3000)])) for _ in range(2500)]  # crosses partitions
    check(spark, table, 8)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report = convrepair.conversation_report(df)
    assert report.columns == ["conv_id", *COUNTS] and report.count() == 0
    assert convrepair.repaired_digests(df, report).count() == 0


def test_query(spark, tmp_path):
    root = "/root/testdata/sf0.01"
    odd = spark.createDataFrame([(None, 1, "user", "a"), (900001, None, None, None), (900001, 2, "user", "b.")],
                                "conv_id long, turn long, role string, text string")
    extra = spark.createDataFrame([(900002 + i, 0, "user", "only.") for i in range(40)], odd.schema)
    spark.read.parquet(f"{root}/conversations.parquet").unionByName(odd).unionByName(extra).write.parquet(f"{tmp_path}/conversations.parquet")
    given = spark.read.parquet(f"{tmp_path}/conversations.parquet").collect()
    after = {r["conv_id"]: [] for r in given}
    for conv, turn, role, text in given:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            after[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    assert sorted(map(tuple, damaged(spark.read.parquet(f"{tmp_path}/conversations.parquet")).collect()), key=repr) == sorted(
        ((c, *r) for c, rows in after.items() for r in rows), key=repr)
    out = {r["conv_id"]: r for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(out) == set(after)
    assert any(not rows for rows in after.values())
    for conv, rows in after.items():
        wanted, sha = by_loop(rows)
        assert (tuple(out[conv][c] for c in COUNTS), out[conv]["repaired_sha256"]) == (wanted, sha)
