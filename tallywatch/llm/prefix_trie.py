"""Prefix trie of conversations, its subtree totals by time-forward processing.

A turn is named by a digest of role and text, a node by its depth and two 64-bit hashes of all names on its path, so equal prefixes
meet by equality and no text is shuffled. Positions and path hashes are running totals over ranges and slices of a
conversation, so one conversation may span many tasks.

Nodes are dealt to shards by their smallest member and a slice of depths. Spark sorts each shard in
reverse level order; one pass goes through it and hands each node's subtree totals to its parent through a priority queue that
holds a bounded number of messages and spills the later ones. A first pass gives the totals of the shards' roots; these form a
smaller tree across shards, whose totals come from doubling steps (as many as the logarithm of its height); a second pass
adds to each node what arrives from other shards.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.tables import partitions_for, stored

WORDS = r"[^\x20\x09-\x0D]+"
SLICE = 100_000  # turns of a conversation that one task numbers
FAMILY = 20  # neighbouring conversation ids whose nodes share a shard
LEVELS = 4096  # depths that share a shard
QUEUE = 200_000  # messages a queue holds in memory
CHUNK = 1 << 20  # bytes of joined ids in one row


# --- turns and paths --------------------------------------------------------------------------


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, pos (from 1), name, words, length``: every turn at its place; repeated rows are turns of their own.

    Turns are ordered by ``turn``, null first, equal ones by their name (a digest of role and text). Null roles and
    texts are empty ones; rows without a conversation id take no part.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("name"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    rows = rows.groupBy("conv", "turn", "name", "words").agg(F.count(F.lit(1)).alias("copies"))
    ranged = rows.repartitionByRange(partitions_for(spark), "conv", "turn", "name").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "trie-turns")
    parts = ranged.groupBy("conv", "part").agg(F.sum("copies").alias("copies"))
    by_part = Window.partitionBy("conv").orderBy("part")
    parts = parts.select(
        "conv",
        "part",
        F.coalesce(F.sum("copies").over(by_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
        F.sum("copies").over(Window.partitionBy("conv")).alias("length"),
    )
    within = Window.partitionBy("conv", "part").orderBy("turn", "name").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("copies").over(within), F.lit(0))).join(parts, ["conv", "part"])
    pos = F.explode(F.sequence(F.col("earlier") + F.col("before") + 1, F.col("earlier") + F.col("before") + F.col("copies")))
    return placed.select("conv", pos.alias("pos"), "name", "words", "length")


def rebuilt(placed: DataFrame, most: int, heads: Column, base: Column) -> DataFrame:
    """``conv, pos, name, words, length`` of every conversation that takes its first ``heads`` (at most ``most``) turns from conversation ``base``.

    The first ``heads`` turns of the base come first (all if it has fewer, none if it is absent), then the
    conversation's own turns after its first ``heads``. A conversation without turns left has one row with pos 0.
    """
    sizes = placed.filter("pos = 1").select("conv", "length").withColumn("h", heads.cast("long")).withColumn("base", base)
    first = placed.filter(F.col("pos") <= most).join(sizes.select(F.col("base").alias("conv")).distinct(), "conv", "left_semi")
    first = first.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "name", "words"))).alias("first"))
    plan = sizes.join(first, "base", "left").withColumn("lead", F.least("h", F.coalesce(F.size("first"), F.lit(0))).cast("long"))
    plan = plan.withColumn("lead", F.when(F.col("first").isNull(), F.lit(0).cast("long")).otherwise(F.col("lead")))
    plan = plan.withColumn("total", F.col("lead") + F.greatest(F.col("length") - F.col("h"), F.lit(0)))
    given = plan.filter("lead > 0").select("conv", "total", F.explode(F.slice("first", F.lit(1), F.col("lead").cast("int"))).alias("t"))
    given = given.select("conv", "t.pos", "t.name", "t.words", F.col("total").alias("length"))
    own = placed.drop("length").withColumn("part", F.floor(F.col("pos") / F.lit(SLICE)))
    parts = plan.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("length") / F.lit(SLICE))))).select("conv", "part", "h", "lead", "total")
    own = own.join(parts, ["conv", "part"]).filter("pos > h").select("conv", (F.col("lead") + F.col("pos") - F.col("h")).alias("pos"), "name", "words", F.col("total").alias("length"))
    none = plan.filter("total = 0").select("conv", F.lit(0).cast("long").alias("pos"), F.lit("").alias("name"), F.lit(0).cast("long").alias("words"), F.col("total").alias("length"))
    return own.unionByName(given).unionByName(none)


def paths(placed: DataFrame) -> DataFrame:
    """``conv, node, parent, words, ends`` for every turn, and one row of the root for every conversation without turns.

    A node is (depth, a, b): the hashes are running exclusive-ors of the hashes of (position, name), cut into slices.
    """
    terms = placed.filter("pos > 0").select("conv", "pos", "words", (F.col("pos") == F.col("length")).alias("ends"), F.floor(F.col("pos") / F.lit(SLICE)).alias("part"), *[F.xxhash64(F.lit(seed), "pos", "name").alias(c) for seed, c in ((11, "x"), (13, "y"))])
    parts = terms.groupBy("conv", "part").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = parts.select("conv", "part", *[F.coalesce(F.bit_xor(c).over(earlier), zero).alias(f"{c}0") for c in "xy"])
    so_far = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = terms.withColumns({f"{c}s": F.bit_xor(c).over(so_far) for c in "xy"}).join(carried, ["conv", "part"])
    a, b = (F.col(f"{c}s").bitwiseXOR(F.col(f"{c}0")) for c in "xy")
    node = F.struct(F.col("pos").alias("depth"), a.alias("a"), b.alias("b"))
    parent = F.struct((F.col("pos") - 1).alias("depth"), a.bitwiseXOR(F.col("x")).alias("a"), b.bitwiseXOR(F.col("y")).alias("b"))
    some = running.select("conv", node.alias("node"), parent.alias("parent"), "words", "ends")
    root = F.struct(zero.alias("depth"), zero.alias("a"), zero.alias("b"))
    none = placed.filter("pos = 0").select("conv", root.alias("node"), F.lit(None).cast(some.schema["parent"].dataType).alias("parent"), zero.alias("words"), F.lit(True).alias("ends"))
    return some.unionByName(none)


# --- nodes ------------------------------------------------------------------------------------


def nodes(walked: DataFrame) -> DataFrame:
    """``node, parent, conv_id, n_convs, words`` for every node, the root among them."""
    deep = walked.filter("node.depth > 0").groupBy("node").agg(F.first("parent").alias("parent"), F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"))
    # every conversation has one row at depth 1, or the one of the root
    tops = walked.filter("node.depth <= 1").agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = F.struct(zero.alias("depth"), zero.alias("a"), zero.alias("b"))
    tops = tops.select(root.alias("node"), F.lit(None).cast(deep.schema["parent"].dataType).alias("parent"), "conv_id", "n_convs", zero.alias("words"))
    return deep.unionByName(tops)


def family(table: DataFrame, shards: int) -> DataFrame:
    """The nodes with ``n_children, parent_conv_id, shard, top`` (the parent is in another shard, or there is none) and ``hosts`` (a child is)."""

    def shard(conv: Column, depth: Column) -> Column:
        return F.pmod(F.xxhash64(F.floor(conv / F.lit(FAMILY)), F.floor(depth / F.lit(LEVELS))), F.lit(shards)).cast("int")

    here = table.withColumn("shard", shard(F.col("conv_id"), F.col("node.depth")))
    above = here.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("shard").alias("parent_shard"))
    known = here.join(above, "parent", "left").withColumn("top", ~F.coalesce(F.col("shard") == F.col("parent_shard"), F.lit(False)))
    below = known.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"), F.bool_or("top").alias("hosts"))
    out = known.drop("parent_shard").join(below, "node", "left")
    return out.withColumns({"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "hosts": F.coalesce("hosts", F.lit(False))})


# --- time-forward processing ------------------------------------------------------------------


class SpillingQueue:
    """Smallest item first; of more than ``most`` items the later ones wait in sorted runs on the task's own disk, as in Spark's sort.

    A run is an unnamed file in Spark's local folder: nothing outside the task reads it and it goes with the task.
    """

    def __init__(self, most: int):
        self.most, self.heap, self.runs = max(most, 2), [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self._spill()

    def _spill(self) -> None:
        items = sorted(self.heap)
        keep = len(items) // 4
        place = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=place)
        for k in range(keep, len(items), 4096):
            pickle.dump(items[k : k + 4096], file)
        file.seek(0)
        self.heap = items[:keep]  # sorted, so a heap
        self._offer(self._read(file))

    def _offer(self, reader: Iterator[tuple]) -> None:
        item = next(reader, None)
        if item is not None:
            heapq.heappush(self.runs, (item, id(reader), reader))

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def peek(self) -> tuple | None:
        heads = [q[0] if q is self.heap else q[0][0] for q in (self.heap, self.runs) if q]
        return min(heads) if heads else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, _, reader = heapq.heappop(self.runs)
            self._offer(reader)
            return item
        return heapq.heappop(self.heap)


def _place(node: dict) -> tuple:
    return -node["depth"], node["a"], node["b"]


def _struct(place: tuple) -> dict:
    return {"depth": -place[0], "a": place[1], "b": place[2]}


class Shard:
    """One pass over a shard's nodes in reverse level order."""

    def __init__(self, most: int):
        self.queue = SpillingQueue(most)
        self.hosts: list[tuple] = []  # nodes with children in other shards, and a forest over them:
        self.up: list[int] = []  # hosts below one node are one set, known by its first
        self.top_of: dict[int, tuple] = {}

    def find(self, k: int) -> int:
        while self.up[k] != k:
            self.up[k] = self.up[self.up[k]]
            k = self.up[k]
        return k

    def step(self, row: dict) -> tuple[int, int]:
        """The totals of a node's subtree as far as it lies in this shard or came with the row."""
        place = _place(row["node"])
        leaves = row["leaves"] + (row["n_children"] == 0)
        saved = row["saved"] + (row["n_convs"] - 1) * row["words"]
        held = -1
        if row["hosts"]:
            held = len(self.hosts)
            self.hosts.append(place)
            self.up.append(held)
        while (head := self.queue.peek()) is not None and head[:3] == place:
            _, _, _, more, sum_, other = self.queue.pop()
            leaves += more
            saved += sum_
            if other >= 0:
                if held >= 0:
                    self.up[self.find(other)] = self.find(held)
                else:
                    held = other
        if row["top"]:
            if held >= 0:
                self.top_of[self.find(held)] = place
        else:
            self.queue.push((*_place(row["parent"]), leaves, saved, held))
        return leaves, saved

    def host_tops(self) -> Iterator[tuple[tuple, tuple]]:
        for k, place in enumerate(self.hosts):
            yield place, self.top_of[self.find(k)]


TOP_SCHEMA = "node struct<depth:long,a:long,b:long>, top struct<depth:long,a:long,b:long>, leaves long, saved long"
ALL_SCHEMA = "node struct<depth:long,a:long,b:long>, leaves long, saved long"


def _pass(batches, most: int, tops_only: bool):
    """Totals of all nodes, or of the shards' tops and, for each node with children elsewhere, the top above it."""
    shard, state, out = None, None, []
    schema = pa.schema([("node", NODE), ("top", NODE), ("leaves", pa.int64()), ("saved", pa.int64())] if tops_only else [("node", NODE), ("leaves", pa.int64()), ("saved", pa.int64())])

    def hosts():
        return [{"node": _struct(h), "top": _struct(t)} for h, t in state.host_tops()] if state is not None and tops_only else []

    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard:
                out += hosts()
                shard, state = row["shard"], Shard(most)
            leaves, saved = state.step(row)
            if not tops_only or row["top"]:
                out.append({"node": row["node"], "leaves": leaves, "saved": saved})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    out += hosts()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


NODE = pa.struct([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _sweep(known: DataFrame, arrived: DataFrame | None, shards: int, queue: int) -> DataFrame:
    """One pass over all shards; ``arrived (node, leaves, saved)``: totals of children in other shards."""
    zero = F.lit(0).cast("long")
    rows = known.select("shard", "node", "parent", "top", "hosts", "n_children", "n_convs", "words")
    if arrived is None:
        rows = rows.withColumns({"leaves": zero, "saved": zero})
    else:
        rows = rows.join(arrived, "node", "left").withColumns({c: F.coalesce(c, zero) for c in ("leaves", "saved")})
    ordered = rows.repartition(shards, "shard").sortWithinPartitions("shard", F.col("node.depth").desc(), "node.a", "node.b")
    tops_only = arrived is None
    return ordered.mapInArrow(lambda batches: _pass(batches, queue, tops_only), TOP_SCHEMA if tops_only else ALL_SCHEMA)


def across_shards(tops: DataFrame, label: str = "trie-tops") -> DataFrame:
    """``node, leaves, saved``: whole totals of every top, from ``node, up, leaves, saved`` of the tree of tops.

    Before step k a top holds the totals of the tops fewer than 2^k levels below it and knows its ancestor 2^k levels above.
    """
    now = stored(tops, label)
    while now.filter("up IS NOT NULL").limit(1).count():
        gain = now.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = now.select(F.col("node").alias("up"), F.col("up").alias("next"))
        zero = F.lit(0).cast("long")
        stepped = now.join(gain, "node", "left").join(above, "up", "left")
        now = stored(stepped.select("node", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved")), label)
    return now.drop("up")


def subtree_totals(known: DataFrame, shards: int, queue: int = QUEUE) -> DataFrame:
    """``node, leaves, saved`` for every row of ``family``: childless nodes and saved tokens of its subtree."""
    first = stored(_sweep(known, None, shards, queue), "trie-first")
    parents = known.filter("top AND parent IS NOT NULL").select("node", F.col("parent"))
    above = first.filter("top IS NOT NULL").select(F.col("node").alias("parent"), F.col("top").alias("up"))
    linked = stored(parents.join(above, "parent", "left"), "trie-links")
    tops = first.filter("top IS NULL").select("node", "leaves", "saved").join(linked.select("node", "up"), "node", "left")
    whole = across_shards(tops.select("node", "up", "leaves", "saved"))
    arrived = linked.join(whole, "node").groupBy(F.col("parent").alias("node")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return _sweep(known, arrived, shards, queue)


# --- members that end at a node ---------------------------------------------------------------


def _joined(batches, most: int):
    """``node, first, ids``: the sorted ids of a node, joined by commas, in rows of about ``most`` bytes."""
    node, ids, size, out = None, [], 0, []
    schema = pa.schema([("node", NODE), ("first", pa.int64()), ("ids", pa.binary())])

    def close():
        if ids:
            out.append({"node": node, "first": ids[0], "ids": ",".join(map(str, ids)).encode()})

    for batch in batches:
        for row in batch.to_pylist():
            if row["node"] != node or size >= most:
                close()
                node, ids, size = row["node"], [], 0
            ids.append(row["conv"])
            size += len(str(row["conv"])) + 1
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def _digests(batches):
    node, state, out = None, None, []
    schema = pa.schema([("node", NODE), ("ends_sha256", pa.string())])
    for batch in batches:
        for row in batch.to_pylist():
            if row["node"] != node:
                if state is not None:
                    out.append({"node": node, "ends_sha256": state.hexdigest()})
                node, state = row["node"], hashlib.sha256(row["ids"])
            else:
                state.update(b",")
                state.update(row["ids"])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": state.hexdigest()}], schema=schema)


def end_digests(walked: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``node, ends_sha256`` for nodes at which a conversation ends. Ids are joined where they were sorted, so a node's digest reads few rows."""
    n = partitions_for(walked.sparkSession)
    ends = walked.filter("ends").select("node", "conv").repartitionByRange(n, "node", "conv").sortWithinPartitions("node", "conv")
    chunks = ends.mapInArrow(lambda batches: _joined(batches, chunk), "node struct<depth:long,a:long,b:long>, first long, ids binary")
    chunks = chunks.repartition(n, "node").sortWithinPartitions("node", "first")
    return chunks.mapInArrow(_digests, "node struct<depth:long,a:long,b:long>, ends_sha256 string")


# --- the whole trie ---------------------------------------------------------------------------


def report(placed: DataFrame, queue: int = QUEUE, shards: int | None = None) -> DataFrame:
    """One row per node of the trie over ``turns`` or ``rebuilt`` conversations.

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. The root has
    depth 0 and counts every conversation, those without turns too; (conv_id, depth) names a node. Without
    conversations there is no node. Only the named columns of the conversations are read.
    """
    spark = placed.sparkSession
    shards = shards or partitions_for(spark)
    walked = stored(paths(placed), "trie-paths")
    known = stored(family(nodes(walked), shards), "trie-nodes")
    totals = subtree_totals(known, shards, queue)
    out = known.join(totals, "node").join(end_digests(walked), "node", "left")
    return out.select(
        "conv_id",
        F.col("node.depth").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
