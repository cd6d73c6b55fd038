"""Connected components of link tables, and exact linking inside blocks of a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.tables import stored


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, component`` for every node of ``edges (a long, b long)``: the smallest node it can reach.

    Star contraction: every node hands its smallest neighbour to its larger ones, then every node sends its
    smaller neighbours to the smallest of them, until only stars are left. A round is two aggregates and two joins
    on the links, however long the chains or large the components; each round is written and read again.
    Nulls and self-links are ignored.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(links.filter(edges["a"].isNotNull() & edges["b"].isNotNull() & (F.col("u") > F.col("v"))).distinct(), label)
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = stored(small.filter("u > v").distinct(), label)
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)


def _are_stars(links: DataFrame) -> bool:
    """Whether every larger end has one link, and no smaller end is a larger end elsewhere: each component is its smallest node's star."""
    ends = links.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    if ends.filter("n > 1").agg(F.count(F.lit(1))).first()[0]:
        return False
    return not links.select(F.col("v").alias("u")).distinct().join(links.select("u"), "u", "left_semi").agg(F.count(F.lit(1))).first()[0]


def block_pairs(df: DataFrame, group: str, size: str, spread: str, most: int) -> DataFrame:
    """Deal the rows of each group to tasks that together see every pair of the group's rows.

    A group of up to ``most`` rows is one task's. A larger one is cut into blocks by a hash of ``spread``, and
    each pair of blocks is one key; a row goes to as many keys as there are blocks. Adds ``key`` and ``side``
    (0 and 1 for the two blocks, 2 where a block meets itself).
    """
    blocks = F.ceil(F.col(size) / most).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(7), spread), F.col("_blocks")).cast("int")
    pair = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    out = df.withColumn("_blocks", blocks).withColumn("_mine", mine).withColumn("_other", pair)
    out = out.withColumn("key", F.struct(F.col(group).alias("g"), F.least("_mine", "_other").alias("i"), F.greatest("_mine", "_other").alias("j")))
    side = F.when(F.col("_mine") == F.col("_other"), 2).when(F.col("_mine") < F.col("_other"), 0).otherwise(1)
    return out.withColumn("side", side.cast("int")).drop("_blocks", "_mine", "_other")


class Forest:
    """Disjoint sets of positions 0 to n - 1; a set is known by its smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return int(k)

    def roots(self) -> np.ndarray:
        """The smallest member of each position's set."""
        parent = self.parent
        while True:
            up = parent[parent]
            if (up == parent).all():
                return parent
            parent[:] = up

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def runs(batches: Iterator, keys: Callable) -> Iterator[tuple[object, list]]:
    """Rows of consecutive equal keys, gathered across Arrow batches: (key, parts of batches)."""
    held, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = keys(batch)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if parts and values[a] != held:
                yield held, parts
                parts = []
            held = values[a]
            parts.append(batch.slice(a, b - a))
    if parts:
        yield held, parts
