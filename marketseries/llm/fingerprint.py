"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of each of the three subtables (a power of two, 16 at most for the bits used), and rounds of peeling.
CELLS, ROUNDS = 16, 14
#: Parts that a comparison is cut into, one trial after another; each part has a table of its own.
TRIALS = (1, 4, 16, 64, 256, 1024, 4096)
#: Rows of a range of documents, and the most ranges.
RANGE_ROWS, MOST_RANGES = 1000, 8192

_EMPTY = "named_struct('n', 0, 'k', 0L, 'h', 0)"


def _places(key: str) -> list[str]:
    """Cell of a digest in each subtable, from bits 0, 20 and 40 on; parts are cut by the bits from 44 on."""
    return [f"(cast(shiftrightunsigned({key}, {20 * j}) & {CELLS - 1}L as int) + {CELLS * j})" for j in range(3)]


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs (lines) of a text; an empty text has one empty paragraph."""
    return F.array_distinct(F.transform(F.split(text, "\n", -1), lambda p: F.xxhash64(p)))


def _sketch(keys: str) -> str:
    hit = " or ".join(f"x.p{j} = c" for j in range(3))
    items = f"transform({keys}, k -> named_struct('k', k, 'h', hash(k), {', '.join(f'\'p{j}\', {p}' for j, p in enumerate(_places('k')))}))"
    cell = (f"aggregate(v, {_EMPTY}, (a, x) -> if({hit}, named_struct('n', a.n + 1, 'k', a.k ^ x.k, 'h', a.h ^ x.h), a))")
    return f"transform(array({items}), v -> transform(sequence(0, {3 * CELLS - 1}), c -> {cell}))[0]"


def _peeled(a: str, b: str) -> str:
    """Digests (k) on one side only (n: 1 for the first, -1 for the second); null if some cells can't be peeled."""
    gap = f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h))"
    pure = "array_distinct(transform(filter(s.c, x -> abs(x.n) = 1 and x.h = hash(x.k)), x -> named_struct('n', x.n, 'k', x.k)))"
    own = " or ".join(f"{p} = i" for p in _places("y.k"))
    less = (f"transform(s.c, (x, i) -> aggregate(filter(v, y -> {own}), x, "
            "(e, y) -> named_struct('n', e.n - y.n, 'k', e.k ^ y.k, 'h', e.h ^ hash(y.k))))")
    step = f"transform(array({pure}), v -> if(size(v) = 0, s, named_struct('c', {less}, 'f', concat(s.f, v))))[0]"
    start = f"named_struct('c', {gap}, 'f', cast(array() as array<struct<n:int,k:bigint>>))"
    done = "if(exists(z.c, x -> x.n <> 0 or x.k <> 0 or x.h <> 0), cast(null as array<struct<n:int,k:bigint>>), z.f)"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> {step}, z -> {done})"


def sketch(keys: str) -> Column:
    """Cells (n, k, h) of the digests in a column: their number, and the exclusive or of digests and of their hashes."""
    return F.expr(_sketch(keys))


def fingerprint(cells: str) -> Column:
    """The cells in use as text: place, number, digests, hashes."""
    shown = "concat_ws('.', i, x.n, lower(hex(x.k)), lower(hex(x.h)))"
    return F.expr(f"array_join(filter(transform({cells}, (x, i) -> if(x.n = 0 and x.k = 0, '', {shown})), y -> y <> ''), ' ')")


def differences(a: str, b: str, a_cells: str, b_cells: str) -> Column:
    """Digests (n, k) that only one of two columns of digests has, recovered from the difference of their sketches.

    Where peeling fails, the sketches are made anew of 4, 16, ... parts with a table each, until it succeeds; texts
    that differ in more than about 100,000 paragraphs and still fail are compared by their lists of digests.
    """
    trials = [_peeled(a_cells, b_cells)]
    for parts in TRIALS[1:]:
        part = lambda keys: _sketch(f"filter({keys}, k -> (shiftrightunsigned(k, 44) & {parts - 1}L) = p)")  # noqa: B023, E731
        all_parts = f"transform(sequence(0L, {parts - 1}L), p -> {_peeled(part(a), part(b))})"
        trials.append(f"transform(array({all_parts}), w -> if(exists(w, q -> q is null), cast(null as array<struct<n:int,k:bigint>>), flatten(w)))[0]")
    side = lambda n, x, y: f"transform(array_except({x}, {y}), k -> named_struct('n', {n}, 'k', k))"
    trials.append(f"concat({side(1, a, b)}, {side(-1, b, a)})")
    return F.expr(f"coalesce({', '.join(trials)})")


def likeness(a: str, b: str, a_cells: str, b_cells: str) -> Column:
    """Common paragraphs by all paragraphs of two texts: 1 for equal sets, 0 for none in common."""
    both = F.size(a) + F.size(b)
    apart = F.size(differences(a, b, a_cells, b_cells))
    return ((both - apart) / (both + apart)).cast("double")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text): each row with the text of the next one by (doc_id, text), the last with the first.

    Rows are cut into ranges at approximate percentiles of doc_id and cross the shuffle once; the first rows of a range
    also go to the range before it. Null text is empty; rows without doc_id are left out.
    """
    rows = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = rows.count()
    ranges = max(1, min(MOST_RANGES, total // RANGE_ROWS))
    cuts: list[int] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = sorted(set(rows.select(F.percentile_approx("doc_id", shares, 100_000)).first()[0]))
    place = F.lit(0)
    if cuts:
        steps = len(cuts).bit_length()
        bounds = f"array({', '.join(f'{c}L' for c in cuts)})"
        # halving: how many cuts are not above the id
        place = F.expr(
            f"aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', {len(cuts)}), (s, i) -> if(s.lo >= s.hi, s, "
            f"if({bounds}[(s.lo + s.hi) div 2] <= doc_id, named_struct('lo', cast((s.lo + s.hi) div 2 + 1 as int), 'hi', s.hi), "
            "named_struct('lo', s.lo, 'hi', cast((s.lo + s.hi) div 2 as int)))), s -> s.lo)")
    firsts = rows.select("doc_id", place.alias("range")).groupBy("range").agg(F.min("doc_id").alias("first"))
    around = Window.orderBy("range")  # one row for each range
    before = F.coalesce(F.lag("range").over(around), F.last("range").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = firsts.select(F.col("first").alias("_first"), before.alias("_before"))
    dealt = rows.withColumn("range", place).join(F.broadcast(firsts), F.col("doc_id") == F.col("_first"), "left")
    own, copy = F.struct(F.lit(False).alias("copy"), "range"), F.struct(F.lit(True).alias("copy"), F.col("_before").alias("range"))
    dealt = dealt.withColumn("at", F.explode(F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, copy))))
    order = Window.partitionBy("at.range").orderBy("at.copy", "doc_id", "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)).filter("not at.copy").select("doc_id", "text", "next_text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row's text and of its edited text, whose last floor(n / 2) code points are the first of
    the next row's text: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Next rows are those of :func:`with_next`; a single row is its own next. Equal texts have equal fingerprints.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("text")).alias("a"),
        digests(F.col("edited")).alias("b"), digests(F.col("next_text")).alias("c"))
    rows = rows.select("*", *(sketch(k).alias(f"{k}{k}") for k in "abc"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint("aa").alias("fingerprint"), fingerprint("bb").alias("edited_fingerprint"),
        likeness("a", "b", "aa", "bb").alias("near_edited"), likeness("a", "c", "aa", "cc").alias("near_next"))
