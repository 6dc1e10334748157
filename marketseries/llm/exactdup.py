"""Exact duplicates: grouped by a 128-bit hash of the normalised text, told apart by bytes inside a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketseries.session import cut_lineage

#: A group with more than this share of all rows is hot; so there are less than HOT_SHARE such groups, which may be broadcast.
HOT_SHARE = 10_000
#: Runs of white space other than a single space, which stays as it is.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of ``[\\x20\\x09-\\x0D]`` as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def digest128(body: Column) -> Column:
    return F.unhex(F.md5(body))


def text_classes(docs: DataFrame, digest: Callable[[Column], Column] = digest128) -> DataFrame:
    """One row per different text: digest, keep_id (least doc_id, null if all are), group_size, text_sha256.

    Rows are grouped by digest and text, so that bytes are compared wherever digests are equal, and copies are merged
    before they are shuffled.
    """
    rows = docs.select(F.col("doc_id").alias("_id"), normalised(F.col("text")).alias("body"))
    texts = rows.withColumn("digest", digest(F.col("body"))).groupBy("digest", "body")
    texts = texts.agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return texts.select("digest", "keep_id", "group_size", F.sha2("body", 256).alias("text_sha256"))


def _bounded_join(rows: DataFrame, groups: DataFrame, key: str, n_rows: int) -> DataFrame:
    """``rows`` with the values of their group, where any group may hold a large part of the rows.

    Groups above a share of the rows are few and broadcast; their rows leave the shuffled join by a key of their own.
    """
    values = [c for c in groups.columns if c != key]
    hot = groups.filter(F.col("group_size") * HOT_SHARE > n_rows).select(F.col(key).alias("_hot"), F.struct(*values).alias("_found"))
    rows = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    spread = F.unhex(F.md5(F.col("_row").cast("string")))
    apart = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(spread.cast(rows.schema[key].dataType))
    cold = groups.filter(F.col("group_size") * HOT_SHARE <= n_rows).select(F.col(key).alias("_cold"), F.struct(*values).alias("_other"))
    rows = rows.withColumn("_apart", apart).join(cold, F.col("_apart") == F.col("_cold"), "left")
    got = F.coalesce("_found", "_other")
    return rows.select("doc_id", "_row", key, *[got[v].alias(v) for v in values])


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = digest128) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after :func:`normalised`; ``keep_id`` is the least doc_id of the equal texts and
    ``group_size`` their number. Exactly one row of a group is ``kept``: one with that id, also where rows repeat it.
    Null and empty texts are equal and a group of their own; a null doc_id is kept only if the group has no other.
    Other columns are not read; an empty table gives none.
    """
    rows = docs.select("doc_id", digest(normalised(F.col("text"))).alias("digest"))
    rows = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()), "digests")
    classes = cut_lineage(text_classes(docs, digest), "texts")
    n_rows = rows.count()
    shared = classes.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("digest")
    shared = cut_lineage(shared, "collisions")
    if shared.isEmpty():
        found = _bounded_join(rows, classes, "digest", n_rows)
    else:  # texts that share a digest: their rows are read again and told apart by the longer hash
        alone, several = (classes.join(shared, "digest", how) for how in ("left_anti", "left_semi"))
        found = _bounded_join(rows.join(shared, "digest", "left_anti"), alone, "digest", n_rows)
        body = normalised(F.col("text"))
        again = docs.select("doc_id", digest(body).alias("digest"), F.sha2(body, 256).alias("text_sha256"))
        again = again.join(shared, "digest", "left_semi").withColumn("_row", -1 - F.monotonically_increasing_id())
        again = _bounded_join(again.drop("digest"), several.drop("digest"), "text_sha256", n_rows)
        found = found.drop("digest").unionByName(again)
    found = cut_lineage(found.drop("digest"), "groups")
    # of rows that repeat the doc_id that stays, the first is kept
    lead = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    repeated = found.filter(lead).groupBy(F.col("text_sha256").alias("_sha"))
    repeated = repeated.agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    leading = found.filter(lead).join(repeated, F.col("text_sha256") == F.col("_sha"), "left")
    kept = F.col("_first").isNull() | (F.col("_row") == F.col("_first"))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rest = found.filter(~lead).withColumn("kept", F.lit(False))
    return leading.withColumn("kept", kept).select(columns).unionByName(rest.select(columns))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns: of equal texts one with the least doc_id."""
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_all"), normalised(F.col("text")).alias("_body"))
    order = F.struct(F.col("_all.doc_id").isNull(), F.col("_all.doc_id"))
    kept = rows.groupBy(digest128(F.col("_body")).alias("_digest"), "_body").agg(F.min_by("_all", order).alias("_all"))
    return kept.select("_all.*")
