"""The registered queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import (
    attention_lm,
    compression_quality,
    embedding_neardup,
    hard_negatives,
    html_extract,
    imatch,
    length_packing,
    minhash_forest,
    piece_bpe,
    prefix_trie,
    suffix_dedup,
    token_counts,
    wavelet_ids,
)
from tallywatch.llm.tables import table
from tallywatch.session import scratch_dir


BYTE_BPE = "byte_bpe_50k.json"


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors inside each label, at a cosine of 0.98."""
    return embedding_neardup.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn(pages)).withColumn("n_chars", F.char_length("text").cast("long"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text and of the text after four drawn edits, recounted from its tree."""
    path = public_tokenizers.path(BYTE_BPE)
    docs = table(spark, sf_dir, "documents").withColumn("edits", token_counts.drawn_edits())
    edited = token_counts.recount(token_counts.count(docs, path, edits_col="edits"), path)
    return edited.select("doc_id", "n_tokens", "n_edited", "n_encoded", F.sha2("text", 256).alias("edited_sha256"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text less its repeated 200-byte strings."""
    out = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", suffix_dedup.n_removed().alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents at 85 percent of 3-word shingles."""
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), minhash_forest.Near(words=3, percent=85))


def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text from its compressed sizes."""
    docs = table(spark, sf_dir, "documents")
    return compression_quality.score(docs, compression_quality.learn(docs, table(spark, sf_dir, "labels")))


def op7_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text and the text decoded from them, as digests."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = piece_bpe.decode(piece_bpe.encode(table(spark, sf_dir, "documents"), model), model)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, written as wavelet-matrix shards and read back from them."""
    path = scratch_dir(spark, "wavelet-ids")
    wavelet_ids.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BYTE_BPE), end_id=0)
    read = wavelet_ids.read_ids(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return wavelet_ids.with_start(read, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's tokens in sequences, bucketed by length and batched."""
    return length_packing.pack_texts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, with likeness to the edited and the next text."""
    report = imatch.edit_report(table(spark, sf_dir, "documents"))
    return report.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        imatch.fingerprint_text("fp").alias("fingerprint"),
        imatch.fingerprint_text("edited_fp").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the conversations, each rebuilt on the first turns of another one."""
    placed = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return prefix_trie.report(prefix_trie.rebuilt(placed, 3, heads, F.col("conv") - F.col("conv") % 20))


def op12_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text by the attention model, learned from six of seven texts, and by smoothed word counts."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return attention_lm.score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), held)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor (ids divisible by 50) and each of its five positives."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_embedding_neardup": op1_embedding_neardup,
    "op2_html_extract": op2_html_extract,
    "op3_token_counts": op3_token_counts,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_minhash_forest": op5_minhash_forest,
    "op6_compression_quality": op6_compression_quality,
    "op7_piece_bpe": op7_piece_bpe,
    "op8_wavelet_ids": op8_wavelet_ids,
    "op9_length_packing": op9_length_packing,
    "op10_imatch": op10_imatch,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_attention_lm": op12_attention_lm,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op1_embedding_neardup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
u AS (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE a.size > 0 AND b.size > 0 AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id,
  vec_id <= coalesce(y, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON vec_id = counted.x LEFT JOIN least_of ON vec_id = least_of.x""",
    "op5_minhash_forest": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS s FROM words),
parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM parts a JOIN parts b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id,
  doc_id <= coalesce(y, doc_id) AS kept
FROM sets LEFT JOIN least_of ON doc_id = least_of.x""",
    "op11_prefix_trie": r"""
WITH own AS (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT DISTINCT c, flatten(list_transform(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda x: [x, -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM own),
heads AS (
  SELECT c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), steps), lambda r, e:
    CASE WHEN e >= 0 THEN xor(r, e) WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END), 4294967295) % 4 AS h FROM bits),
leads AS (SELECT c, h, (SELECT count(*) FROM own b WHERE b.c = heads.c - heads.c % 20 AND b.p <= h) AS lead FROM heads),
rebuilt AS (
  SELECT l.c, b.p AS d, b.name, b.words FROM leads l JOIN own b ON b.c = l.c - l.c % 20 AND b.p <= l.h
  UNION ALL SELECT l.c, l.lead + o.p - l.h, o.name, o.words FROM leads l JOIN own o ON o.c = l.c AND o.p > l.h),
paths AS (
  SELECT c, d, words, string_agg(name, ',') OVER (PARTITION BY c ORDER BY d) AS path, d = max(d) OVER (PARTITION BY c) AS ends FROM rebuilt
  UNION ALL SELECT c, 0, 0, '', c NOT IN (SELECT c FROM rebuilt) FROM leads),
nodes AS (
  SELECT path, d, min(c) AS c, count(*) AS n, max(words) AS words, string_agg(CASE WHEN ends THEN CAST(c AS VARCHAR) END, ',' ORDER BY c) AS ending
  FROM paths GROUP BY path, d),
family AS (
  SELECT v.*, u.c AS parent FROM nodes v LEFT JOIN nodes u ON v.d > 0 AND u.d = v.d - 1
    AND u.path = CASE WHEN v.d = 1 THEN '' ELSE left(v.path, length(v.path) - 33) END),
counted AS (SELECT parent AS c, d - 1 AS d, count(*) AS n_children FROM family WHERE d > 0 GROUP BY ALL),
valued AS (SELECT v.c, v.d, (v.n - 1) * v.words AS saved, k.n_children IS NULL AS leaf FROM nodes v LEFT JOIN counted k ON k.c = v.c AND k.d = v.d),
totals AS (
  SELECT a.path, a.d, sum(v.saved) AS saved, sum(CAST(v.leaf AS BIGINT)) AS leaves FROM valued v JOIN paths a ON a.c = v.c AND a.d <= v.d GROUP BY a.path, a.d)
SELECT f.c AS conv_id, f.d AS depth, f.parent AS parent_conv_id, f.n AS n_convs, coalesce(n_children, 0) AS n_children,
  CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ending, '')) AS ends_sha256
FROM family f JOIN totals t ON t.path = f.path AND t.d = f.d LEFT JOIN counted k ON k.c = f.c AND k.d = f.d""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""",
}
