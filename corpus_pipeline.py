"""Training-corpus pipeline: language ID, near-duplicates, repeated passages, packing into token windows.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
``run`` writes each stage's result as Parquet to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketseries.llm.langid import UNDETERMINED, identify, references
from marketseries.llm.neardup import near_duplicates
from marketseries.llm.packing import pack_documents
from marketseries.llm.queries import tokenizer
from marketseries.llm.suffixdedup import remove_repeated
from marketseries.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters; a missing ``lang`` is filled in, where any row tells what a language looks like.

    Null texts and texts without letters go.
    """
    known = references(docs, "true")
    named = identify(docs.select(*COLUMNS), known)
    named = named.filter(F.col("lang_pred") != UNDETERMINED) if known else named.filter(F.col("text").rlike(r"\p{L}"))
    told = F.when(F.col("lang_pred") != UNDETERMINED, F.col("lang_pred"))
    return named.withColumn("lang", F.coalesce("lang", told)).select(*COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles: that with the least doc_id.

    Rows without doc_id, and rows whose doc_id stands with several texts, are documents of their own that come after
    all others in that order; rows equal in doc_id and text are one.
    """
    docs = docs.select(*COLUMNS)
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    odd = cut_lineage(counts.filter("n > 1 or doc_id is null").select(F.col("doc_id").alias("_odd")), "repeated")
    if odd.isEmpty():
        gone = near_duplicates(docs, words=5, percent=80).filter("not kept").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    above = (docs.agg(F.max("doc_id")).first()[0] or 0) + 1
    same = F.col("doc_id").eqNullSafe(F.col("_odd"))
    apart = docs.join(odd, same, "left_semi").dropDuplicates(["doc_id", "text"])
    apart = cut_lineage(apart.withColumn("_key", F.monotonically_increasing_id() + above), "repeated")
    keyed = docs.join(odd, same, "left_anti").withColumn("_key", F.col("doc_id")).unionByName(apart)
    asked = keyed.select(F.col("_key").alias("doc_id"), "text")
    gone = near_duplicates(asked, words=5, percent=80).filter("not kept").select(F.col("doc_id").alias("_key"))
    return keyed.join(gone, "_key", "left_anti").select(*COLUMNS)


#: Bytes of the strings that are removed where they repeat: less than any passage of over 50 words has.
PASSAGE_BYTES = 200


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of ``PASSAGE_BYTES`` that start anywhere else, too; ``n_chars`` follows the text."""
    out = remove_repeated(docs.select(*COLUMNS), PASSAGE_BYTES)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return pack_documents(docs, tokenizer("byte_bpe_50k.json"), 1024, 0)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicate),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: SQL can express none of the models, tokenizers and solvers here; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, last = STAGES
    for name, stage in first:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return last[1](spark, docs, sf_dir)
