"""From raw documents to training batches: reject junk, keep one of each near-duplicate group, cut repeated passages, pack.

Each stage is written as Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``, whatever those are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import compression_quality, length_packing, minhash_forest, suffix_dedup
from tallywatch.llm.tables import packed, stored, table

TOKENIZER = "byte_bpe_50k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the compression classifier (6) predicts to be good. Empty texts share one score and so one fate."""
    model = compression_quality.learn(docs, table(spark, sf_dir, "labels"))
    return compression_quality.with_score(docs, model).filter("score >= 0.5").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (5): that with the group's smallest id.

    A row is named by a 64-bit hash of its id and text, so rows that repeat an id, or have none, are compared by
    their texts. Rows with equal id and text are one; texts without words link with nothing else.
    """
    rows = packed(docs).withColumn("id", F.col("row.doc_id").cast("long"))
    text = F.col("row.text")
    rows = rows.withColumn("name", F.xxhash64(F.col("id").isNull(), "id", text.isNull(), text))
    groups = minhash_forest.near_duplicates(rows.select("name", text.alias("text")), id_col="name").select(F.col("doc_id").alias("name"), "component_id").distinct()
    first = groups.join(rows.select("name", "id").distinct(), "name").groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "name")).alias("first"))
    one = rows.groupBy("name").agg(F.min_by("row", F.xxhash64("row.text")).alias("row"))
    return one.join(first.select(F.col("first.name").alias("name")), "name", "left_semi").select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated 200-byte strings (4). Documents of which nothing is left go.

    Where a cut splits a character, its other bytes go too. ``n_chars`` follows the text; a text that loses
    nothing stays as it is, null or empty ones included.
    """
    cut = suffix_dedup.without_repeats(docs)
    whole = F.size("removed") == 0
    text = F.when(whole, F.col("row.text")).otherwise(F.try_validate_utf8(F.col("kept").cast("string")))
    text = F.coalesce(text, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\uFFFD", ""))
    text = F.when(whole, F.col("row.text")).otherwise(text)
    left = cut.withColumn("text", text).filter(whole | (F.col("text") != ""))
    fresh = {"text": F.col("text"), "n_chars": F.when(whole, F.col("row.n_chars")).otherwise(F.char_length("text").cast("long"))} if "n_chars" in docs.columns else {"text": F.col("text")}
    return left.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in length buckets and batches (9)."""
    return length_packing.pack_texts(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: Learned scores, sketches and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
