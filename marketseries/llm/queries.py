"""Registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), 1024, 0)


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@query
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm.neighbours import nearest

    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page captures read back from the archives written of the whole table."""
    from pyspark.sql import functions as F

    from marketseries.llm import warc
    from marketseries.session import cut_lineage, scratch_path

    folder = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder, least_bytes=1000)
    captures = warc.assemble(warc.read_records(spark, folder)).select(
        F.col("metadata.fields").getItem("pageId").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", "record_id", F.col("refers_to").alias("_to"))
    captures = cut_lineage(captures, "captures")  # archives are read once
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    # equal rows of the table have equal record ids: one row for each id, so that repeats don't multiply the revisits
    target = captures.filter("_to is null").groupBy(F.col("record_id").alias("_id")).agg(F.min("page_id").alias("refers_to"))
    known = captures.filter("_to is not null").join(target, F.col("_to") == F.col("_id"), "left").select(columns)
    return known.unionByName(captures.filter("_to is null").withColumn("refers_to", F.lit(None).cast("long")).select(columns))


ORACLES["op6_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages WHERE page_id IS NOT NULL),
     d AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
     m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM m
"""


@query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketseries.llm import langid

    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    known = langid.references(docs, "crc32(cast(doc_id as string)) % 3 <> 1")
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), known).drop("text")


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from the token files written of the whole table."""
    from marketseries.llm import tokenfile
    from marketseries.session import scratch_path

    folder = scratch_path(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer("byte_bpe_50k.json"), end_id=2)
    return tokenfile.token_index(spark, folder)


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm.bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm.fingerprint import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm.suffixdedup import byte_report

    return byte_report(table(spark, sf_dir, "documents"), 400)


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm import licenses

    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(licenses.background(docs)))


@query
def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm.exactdup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op11_exact_duplicates"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
     g AS (SELECT *, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults that a hash of conversation and turn decides; nulls are one space."""
    from pyspark.sql import functions as F

    def spaced(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                                (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).alias("_fault"))
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = rows.filter("_fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy"))
    return rows.drop("_copy")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hashlib import sha256

    from pyspark.sql import functions as F

    from marketseries.llm import convrepair
    from marketseries.session import cut_lineage

    given = table(spark, sf_dir, "conversations")
    rows = damaged(given)
    report = cut_lineage(convrepair.conversation_report(rows), "report")
    hashes = convrepair.repaired_digests(rows, report)
    out = given.select("conv_id").distinct()
    for part in (report, hashes):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return out.fillna(counts | {"audit": "", "repaired_sha256": sha256().hexdigest()})


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketseries.llm.lexical import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


ORACLES["op13_ranked_search"] = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
     d AS (SELECT doc_id, len(terms) AS n, terms FROM words WHERE len(terms) > 0),
     s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
     p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM d) GROUP BY doc_id, n, term),
     asked AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
     q AS (SELECT item_id, term, count(*) AS times FROM (
               SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM asked) GROUP BY item_id, term),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s
           WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
     scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
                FROM p, s, q, w WHERE p.term = q.term AND p.term = w.term GROUP BY item_id, doc_id),
     ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
                FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
