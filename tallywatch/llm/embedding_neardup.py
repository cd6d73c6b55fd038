"""Near-duplicate vectors by binary codes of a randomly rotated copy, with stored correction factors.

A unit vector ``o`` is rotated and coded by its signs; with ``s`` the sign vector scaled to length one, the
stored factor is ``f = <s, o>``. For another unit vector ``q``, ``<s, q> / f`` estimates ``<o, q>`` without bias
over rotations. With ``c`` the true value its error is ``sqrt(1 - c^2)`` times at most ``sqrt(1 - f^2) / f``, since
``s`` has no more than that beside ``o``. So a pair with ``c >= t`` has an estimate of at least
``t - sqrt(1 - t^2) sqrt(1 - f^2) / f``: only pairs above that bound are computed exactly, and none is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.links import block_pairs, components, runs
from tallywatch.llm.tables import partitions_for, stored

BLOCK = 4096  # vectors of a group that one task compares with as many others
ROWS = 512  # of a block, estimated at a time
ROUNDING = 1e-4  # of single-precision estimates


def rotation(size: int, seed: int = 1) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([seed, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


class Codes:
    """Signs (packed) and correction factors of unit vectors."""

    def __init__(self, unit: np.ndarray):
        self.rotated = (unit @ rotation(unit.shape[1]).T).astype(np.float32)
        self.size = unit.shape[1]
        self.packed = np.packbits(self.rotated >= 0, axis=1)
        self.factor = np.abs(self.rotated).sum(axis=1) / np.sqrt(self.size)

    def signs(self, rows: slice) -> np.ndarray:
        bits = np.unpackbits(self.packed[rows], axis=1, count=self.size)
        return (2 * bits.astype(np.float32) - 1) / np.float32(np.sqrt(self.size))

    def estimates(self, rows: slice) -> np.ndarray:
        """Inner products of the rows' vectors, seen through their codes, with all vectors."""
        return self.signs(rows) @ self.rotated.T / self.factor[rows, None]

    def least(self, rows: slice, threshold: float) -> np.ndarray:
        """What the estimate of a pair at the threshold cannot fall below."""
        f = np.minimum(self.factor[rows], 1.0)
        return threshold - np.sqrt(1 - threshold**2) * np.sqrt(1 - f**2) / f - ROUNDING


def links_of(vectors: np.ndarray, side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each vector: its links to others and the first position it reaches by links. Sides 0 and 1 meet each other, 2 all."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    codes, n = Codes(unit), len(vectors)
    count, family = np.zeros(n, np.int64), np.arange(n)
    for start in range(0, n, ROWS):
        rows = slice(start, min(start + ROWS, n))
        may = codes.estimates(rows) >= codes.least(rows, threshold)[:, None]
        may &= (side[rows, None] != side) | (side == 2)
        a, b = np.nonzero(may)
        a += start
        later = a < b
        a, b = _exact(unit, a[later], b[later], threshold)
        np.add.at(count, a, 1)
        np.add.at(count, b, 1)
        cuts = np.flatnonzero(np.diff(a, prepend=-1, append=n))
        for k, j in zip(cuts, cuts[1:], strict=False):
            groups = np.unique(family[np.append(b[k:j], a[k])])
            if groups.size > 1:
                family[np.isin(family, groups)] = groups[0]
    # The estimate of (a, b) uses the code of a and that of (b, a) the code of b; either bound holds, so one suffices.
    return count, family


def _exact(unit: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    sure = np.empty(a.size, bool)
    for k in range(0, a.size, 1 << 16):
        part = slice(k, k + (1 << 16))
        sure[part] = np.einsum("ij,ij->i", unit[a[part]], unit[b[part]]) >= threshold
    return a[sure], b[sure]


def _linked(batches, threshold: float):
    """``vec, n_links, first``: vectors with links inside one block or pair of blocks."""
    for _, parts in runs(batches, lambda b: np.array([f"{k['g']} {k['i']} {k['j']}" for k in b.column("key").to_pylist()])):
        table = pa.Table.from_batches(parts).combine_chunks()
        vecs, marks, side = (table.column(c).to_numpy() for c in ("vec", "mark", "side"))
        vectors = np.asarray(table.column("vector").chunk(0).flatten(), np.float64).reshape(vecs.size, -1)
        if vecs.size > 1:
            count, family = links_of(vectors, side, threshold)
            some = np.flatnonzero(count)
            if some.size:
                yield pa.RecordBatch.from_arrays([pa.array(vecs[some]), pa.array(marks[some]), pa.array(count[some]), pa.array(vecs[family[some]])], names=["vec", "mark", "n_links", "first"])


def near_duplicates(embeddings: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; vectors link inside a group (label) by cosine.

    A vector that is null, empty or zero, or holds a null or non-finite component, links with nothing, and
    neither does one without a group or an id; vectors of different lengths do not link. Rows equal in id,
    group and vector are one vector and get the same result. Other columns are not read; an empty table gives
    an empty one. The work is quadratic in a group's size, cut into pairs of blocks; nothing is emitted per pair.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec"), F.col(group_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("mark", F.xxhash64("label", "vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.filter(F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    usable = usable.filter(finite & F.exists("vector", lambda x: x != 0)).dropDuplicates(["vec", "mark"])
    usable = usable.withColumn("group", F.concat_ws(":", F.size("vector").cast("string"), "label"))
    sizes = usable.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    dealt = block_pairs(usable.join(sizes, "group"), "group", "n", "vec", BLOCK).select("key", "side", "vec", "mark", "vector")
    dealt = dealt.repartition(partitions_for(spark), "key").sortWithinPartitions("key", "vec", "mark")
    found = stored(dealt.mapInArrow(lambda batches: _linked(batches, threshold), "vec long, mark long, n_links long, first long"), "vector-links")
    family = components(found.select(F.col("vec").alias("a"), F.col("first").alias("b")), "vector-families")
    counts = found.groupBy("vec", "mark").agg(F.sum("n_links").alias("n_links"))
    out = rows.select("vec", "mark").join(counts, ["vec", "mark"], "left").join(family, F.col("vec") == F.col("node"), "left")
    component = F.coalesce("component", "vec")
    return out.select(F.col("vec").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec") == component, F.lit(True)).alias("kept"))
