"""Near-duplicate documents by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Documents with the same shingle set are one node. Each tree of the forest orders the nodes by its own run of
signature values; nodes that share a prefix of ``least_depth`` values are neighbours and form a region. Inside
a region whole signatures are compared (in one task for each pair of blocks, if it holds more than ``region``
nodes), and nodes that may be similar are chained. The chains of all trees give candidate families; a family's
full sets meet in one task (or in one task for each pair of blocks, if it is large), where every pair that may
link is decided exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.links import Forest, block_pairs, components, runs
from tallywatch.llm.tables import map_batches, partitions_for, stored, text_or_empty

VALUES = 128


@dataclass(frozen=True)
class Near:
    """Similarity ``percent`` (of shingles of ``words`` words) from which documents link; the forest's shape.

    A pair at the threshold shares a prefix of 3 values in one of 12 trees with probability 1 - 1e-5 (85 percent)
    or 1 - 2e-4 (80 percent). ``slack``: a pair is compared exactly if its estimated similarity is at most so many
    standard deviations below the threshold. ``region`` and ``block`` bound what a task compares at once; larger
    groups are compared in pairs of blocks. A tree owns ``depth`` values, of which it reads ``least_depth``.
    """

    words: int = 5
    percent: int = 80
    trees: int = 12
    depth: int = 10
    least_depth: int = 3
    region: int = 2048
    block: int = 4096
    slack: float = 4.5

    @property
    def estimate(self) -> float:
        p = self.percent / 100
        return p - self.slack * (p * (1 - p) / VALUES) ** 0.5


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Distinct shingle hashes and signatures; words are runs of bytes other than ASCII white space, A-Z lowered."""

    def __init__(self, words: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.words = words
        self.base = np.uint64(0x9E3779B97F4A7C15)
        inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.steps = (self.base, inverse)
        self.powers, self.inverse = (np.ones(1, np.uint64) for _ in range(2))
        lower = np.arange(256, dtype=np.uint64) + 1
        lower[65:91] += 32
        self.lower = _mix(lower)
        self.space = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
        self.xor = rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)
        self.times = rng.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)

    def _grow(self, n: int) -> None:
        if n >= self.powers.size:
            size = max(n + 1, 2 * self.powers.size)
            self.powers, self.inverse = (np.concatenate([np.ones(1, np.uint64), np.full(size, b).cumprod(dtype=np.uint64)]) for b in self.steps)

    def shingles(self, text: bytes) -> np.ndarray:
        """Sorted distinct 64-bit hashes."""
        data = np.frombuffer(text, np.uint8)
        inside = ~self.space[data]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        if not starts.size:
            return np.empty(0, np.uint64)
        self._grow(data.size)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.lower[data] * self.powers[: data.size], dtype=np.uint64)])
        word = _mix((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        k = min(self.words, word.size)
        out = word[: word.size - k + 1].copy()
        for step in range(1, k):
            out = out * self.base + word[step : word.size - k + 1 + step]
        return np.unique(_mix(out + np.uint64(k)))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest of each of 128 random orders of the shingles; all ones if there are none."""
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
        for at in range(0, low.size, 4096):
            out = np.minimum(out, ((low[at : at + 4096, None] ^ self.xor) * self.times).min(axis=0))
        return out


def signatures(docs: DataFrame, near: Near, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b`` (a 128-bit name of the shingle set) and the signature."""

    def start():
        shingler = Shingler(near.words)

        def step(batch):
            sizes, names, bodies = [], [], []
            for text in batch.column(1):
                s = shingler.shingles(text.as_buffer())
                sizes.append(s.size)
                names.append((int(s.sum(dtype=np.uint64).astype(np.int64)), int(_mix(s * shingler.base).sum(dtype=np.uint64).astype(np.int64))))
                bodies.append(shingler.signature(s).tobytes())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), pa.array(bodies, pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    return map_batches(rows, "doc_id long, n_shingles long, set_a long, set_b long, signature binary", start)


def _tree_rows(nodes: DataFrame, near: Near) -> DataFrame:
    """One row for each node and tree: the tree's run of signature values as far as it is read, and 8 bits of every value."""

    def step(batch):
        n = batch.num_rows
        whole = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(n, VALUES)
        short = (whole >> 24 ^ whole >> 16).astype(np.uint8)
        runs_ = np.ascontiguousarray(whole[:, : near.trees * near.depth]).reshape(n * near.trees, near.depth)[:, : near.least_depth]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(batch.column(0).to_numpy(), near.trees)),
                pa.array(np.tile(np.arange(near.trees, dtype=np.int32), n)),
                pa.array([r.tobytes() for r in runs_], pa.binary()),
                pa.array([s for s in map(bytes, short) for _ in range(near.trees)], pa.binary()),
            ],
            names=["node", "tree", "run", "short"],
        )

    return map_batches(nodes.select("node", "signature"), "node long, tree int, run binary, short binary", lambda: step)


def regions(rows: DataFrame, near: Near) -> DataFrame:
    """``region, side`` and the rows of ``_tree_rows`` that share their first ``near.least_depth`` values with another.

    A prefix of more than ``near.region`` nodes is dealt to one region for each pair of its blocks, so that every
    pair of its nodes still meets in this tree.
    """
    first = rows.withColumn("p", F.xxhash64("tree", F.substring("run", 1, 4 * near.least_depth)))
    counts = first.groupBy("p").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    dealt = block_pairs(first.join(counts, "p"), "p", "n", "node", near.region)
    return dealt.select(F.xxhash64("key.g", "key.i", "key.j").alias("region"), "side", "node", "tree", "run", "short")


def _chains(batches, near: Near):
    """Links ``a, b`` that join the nodes of each region which may be similar, a star for each family of them.

    Pairs already known to be connected are not compared again; ``side`` is that of ``block_pairs``.
    """
    for _, parts in runs(batches, lambda b: b.column(0).to_numpy()):
        table = pa.Table.from_batches(parts)
        nodes = table.column("node").to_numpy()
        if nodes.size < 2:
            continue
        side = table.column("side").to_numpy()
        short = np.frombuffer(b"".join(table.column("short").to_pylist()), np.uint8).reshape(-1, VALUES)
        enough = near.estimate * VALUES
        forest = Forest(nodes.size)
        for k in range(nodes.size - 1):
            roots = forest.roots()
            after = roots[k + 1 :] != roots[k]
            if side[k] != 2:
                after &= side[k + 1 :] != side[k]
            after = np.flatnonzero(after) + k + 1
            for j in after[(short[k] == short[after]).sum(axis=1, dtype=np.int32) >= enough]:
                forest.join(k, int(j))
        roots = forest.roots()
        far = np.flatnonzero(roots != np.arange(nodes.size))
        if far.size:
            yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[roots[far]])], names=["a", "b"])


def _decide(batches, near: Near):
    """Links confirmed on full sets, as stars; one run of rows is one family or one pair of its blocks."""
    for _, parts in runs(batches, lambda b: np.array([f"{k['g']} {k['i']} {k['j']}" for k in b.column("key").to_pylist()])):
        table = pa.Table.from_batches(parts)
        nodes, side = table.column("node").to_numpy(), table.column("side").to_numpy()
        sets = [np.frombuffer(x, "<u8") for x in table.column("shingles").to_pylist()]
        whole = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(-1, VALUES)
        links = link_exactly(sets, whole, side, near)
        far = np.flatnonzero(links != np.arange(nodes.size))
        if far.size:
            yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[links[far]])], names=["a", "b"])


def link_exactly(sets: list[np.ndarray], whole: np.ndarray, side: np.ndarray, near: Near) -> np.ndarray:
    """The smallest position each position reaches by pairs of similar sets.

    Pairs already known to be connected are not compared again; neither are pairs whose sizes or estimates rule
    out the threshold. ``side`` 0 and 1 meet only each other; 2 meets all.
    """
    sizes, n = np.array([s.size for s in sets]), len(sets)
    forest, enough, need = Forest(n), near.estimate * VALUES, near.percent
    for k in range(n - 1):
        after = np.arange(k + 1, n)
        if side[k] != 2:
            after = after[side[k + 1 :] != side[k]]
        roots = forest.roots()
        after = after[(roots[after] != roots[k]) & (100 * np.minimum(sizes[after], sizes[k]) >= need * np.maximum(sizes[after], sizes[k]))]
        after = after[(whole[k] == whole[after]).sum(axis=1) >= enough]
        mine = sets[k]
        for at in range(0, after.size, 256):
            some = after[at : at + 256]
            joined = np.concatenate([sets[j] for j in some])
            place = np.minimum(np.searchsorted(mine, joined), mine.size - 1)
            ends = np.cumsum(sizes[some])
            hits = np.concatenate([[0], np.cumsum(mine[place] == joined)])
            inter = hits[ends] - hits[ends - sizes[some]]
            for j in some[100 * inter >= need * (sizes[some] + mine.size - inter)]:
                forest.join(k, int(j))
    return forest.roots()


def full_sets(docs: DataFrame, near: Near) -> DataFrame:
    """Adds ``shingles`` (sorted 64-bit hashes) and ``signature`` to ``node, family, n, text``."""

    def start():
        shingler = Shingler(near.words)

        def step(batch):
            sets = [shingler.shingles(t.as_buffer()) for t in batch.column(3)]
            marks = [shingler.signature(s).tobytes() for s in sets]
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(marks, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["node", "family", "n", "shingles", "signature"])

        return step

    return map_batches(docs.select("node", "family", "n", "text"), "node long, family long, n long, shingles binary, signature binary", start)


def near_duplicates(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Null texts, and texts without words, have no shingles and link with nothing. Rows with equal texts link;
    rows with the same id are one document. A row without an id links with nothing and is kept, with a null
    component. Other columns are not read; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    signed = stored(signatures(docs, near, id_col, text_col), "signatures")
    named = signed.filter("doc_id is not null and n_shingles > 0")
    nodes = stored(named.groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.struct("doc_id", "signature")).alias("x")).select("set_a", "set_b", "n_shingles", F.col("x.doc_id").alias("node"), F.col("x.signature").alias("signature")), "nodes")

    parts = partitions_for(spark)
    placed = regions(_tree_rows(nodes, near), near).select("region", "node", "side", "short").repartition(parts, "region").sortWithinPartitions("region", "node")
    chains = placed.mapInArrow(lambda batches: _chains(batches, near), "a long, b long")
    families = stored(components(chains, "families"), "family")
    sizes = families.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    members = families.join(sizes, "component").select("node", F.col("component").alias("family"), "n")

    texts = docs.select(F.col(id_col).cast("long").alias("node"), text_or_empty(text_col).cast("binary").alias("text"))
    with_sets = full_sets(members.join(texts, "node"), near)
    dealt = block_pairs(with_sets, "family", "n", "node", near.block).select("key", "side", "node", "shingles", "signature")
    dealt = dealt.repartition(parts, "key").sortWithinPartitions("key", "node")
    confirmed = components(dealt.mapInArrow(lambda batches: _decide(batches, near), "a long, b long"), "links")

    by_set = nodes.select("set_a", "set_b", "n_shingles", "node").join(confirmed, "node", "left")
    by_set = by_set.select("set_a", "set_b", "n_shingles", F.coalesce("component", "node").alias("component"))
    own = signed.select("doc_id", "n_shingles", "set_a", "set_b")
    # A row with the smallest id of its set may share that id with another set's rows; both then follow the smaller component.
    out = own.join(by_set, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
