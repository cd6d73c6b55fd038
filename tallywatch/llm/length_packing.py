"""Batches of a token budget inside optimal length buckets.

Documents are cut into sequences of at most ``longest`` tokens. The global histogram of sequence lengths, at
most ``longest`` rows, goes to a dynamic programme that finds the bucket boundaries with the least padding.
Each bucket's batches hold as many sequences as the token budget allows at the bucket's boundary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.byte_ids import worker_counts
from tallywatch.llm.tables import map_batches, stored, text_or_empty


@dataclass(frozen=True)
class Packing:
    """``slice``: sequences of a bucket that one task numbers; each slice may end with one batch that is not full."""

    longest: int = 2048
    buckets: int = 16
    budget: int = 65_536
    slice: int = 200_000


def boundaries(counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding; ``counts[l]`` sequences have length ``l``.

    ``best[k][j]``: the least padding of lengths up to ``j`` in ``k`` buckets of which the last ends at ``j``.
    """
    used = np.flatnonzero(counts)
    if not used.size:
        return []
    number, total = np.cumsum(counts[used]), np.cumsum(counts[used] * used)
    n = used.size
    number, total = np.concatenate([[0], number]), np.concatenate([[0], total])
    best, choice = np.full(n + 1, np.inf), []
    best[0] = 0
    for _ in range(min(buckets, n)):
        fresh, source = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        fresh[0] = 0
        for j in range(1, n + 1):
            padding = best[:j] + (number[j] - number[:j]) * used[j - 1] - (total[j] - total[:j])
            source[j] = int(np.argmin(padding))
            fresh[j] = padding[source[j]]
        best = fresh
        choice.append(source)
    ends, j = [], n
    for source in reversed(choice):
        if j == 0:
            break
        ends.append(int(used[j - 1]))
        j = int(source[j])
    return ends[::-1]


def token_lengths(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens``: ids of every whole text and one end id; a null text has the end id only."""

    def start():
        counts = worker_counts(tokenizer)

        def step(batch):
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([counts.encode(t.as_py()) + 1 for t in batch.column(1)], pa.int64())], names=["doc_id", "n_tokens"])

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_batches(rows, "doc_id long, n_tokens long", start)


def pack(lengths: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """``doc_id, piece, start, n_tokens, bucket, boundary, batch, place`` from ``doc_id, n_tokens``.

    Every token is in exactly one sequence. ``batch`` names the bucket, the slice and the batch in it; ``place``
    counts the sequences of a batch. Sequences are numbered in the order of a hash of id and piece; repeated
    rows each get their own sequences, null ids too. Lengths below one, or null, give no sequence.
    """
    sequences = lengths.select("doc_id", F.col("n_tokens").alias("whole")).filter("whole >= 1")
    last = F.ceil(F.col("whole") / packing.longest).cast("long") - 1
    sequences = sequences.select("doc_id", "whole", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    length = F.least(F.col("whole") - F.col("piece") * packing.longest, F.lit(packing.longest))
    sequences = sequences.select("doc_id", "piece", (F.col("piece") * packing.longest).alias("start"), length.cast("int").alias("n_tokens"))

    histogram = sequences.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``longest`` rows
    counts = np.zeros(packing.longest + 1, np.int64)
    for row in histogram:
        counts[row["n_tokens"]] = row["n"]
    ends = boundaries(counts, packing.buckets)
    lows = [0, *ends][: len(ends)]
    held = [int(counts[a + 1 : b + 1].sum()) for a, b in zip(lows, ends, strict=True)]

    def by_bucket(values: list[int]) -> F.Column:
        return F.element_at(F.array(*[F.lit(v) for v in values or [1]]), F.col("bucket") + 1)

    bucket = F.size(F.filter(F.array(*[F.lit(e) for e in ends or [packing.longest]]), lambda e: e < F.col("n_tokens")))
    out = sequences.withColumn("bucket", bucket).withColumn("boundary", by_bucket(ends))
    order = F.xxhash64("doc_id", "piece", "n_tokens")
    out = out.withColumn("_order", order).withColumn("_slice", F.pmod(F.xxhash64("_order"), by_bucket([max(1, -(-n // packing.slice)) for n in held])).cast("int"))
    number = F.row_number().over(Window.partitionBy("bucket", "_slice").orderBy("_order", "doc_id", "piece")) - 1
    size = by_bucket([max(1, packing.budget // e) for e in ends])
    out = out.withColumn("_number", number).withColumn("_batch", F.floor(F.col("_number") / size).cast("int"))
    name = F.concat_ws("-", F.col("bucket").cast("string"), F.col("_slice").cast("string"), F.col("_batch").cast("string"))
    return out.select("doc_id", "piece", "start", "n_tokens", "bucket", "boundary", name.alias("batch"), F.pmod("_number", size).cast("int").alias("place"))


def pack_texts(docs: DataFrame, tokenizer: str, packing: Packing = Packing()) -> DataFrame:
    """``pack`` of whole texts; their lengths are counted once and written."""
    return pack(stored(token_lengths(docs, tokenizer), "lengths"), packing)
