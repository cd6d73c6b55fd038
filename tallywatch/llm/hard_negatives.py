"""Hard negatives by threshold joins over an inverted index that leaves out what norms already bound.

Rows are dealt to blocks, anchors to packs, and each pair of a pack and a block is one key, so a task holds one block and one
pack however large a label is. Inside a block the dimensions are ordered by weight and each row is indexed only up to
the point from which its remaining norm, times the largest norm of an anchor, stays below the lowest threshold.
Rows are sorted by how far they are indexed, so the list of a dimension is a prefix of the block. Scores
are accumulated dimension by dimension; pairs whose partial score plus remaining norms stays below the
anchor's threshold fall out, the rest are computed in full. Thresholds start high and are lowered for the anchors whose windows are not full.

Components are whole numbers (``floor(scale * x)``), so scores are exact: in doubles below 2^53, beyond that in whole
Python numbers. A score outside 64 bits becomes the nearest 64-bit number in the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.links import runs
from tallywatch.llm.tables import partitions_for, stored

BLOCK = 2048  # rows of a block
PACK = 1024  # anchors of a pack
AT_ONCE = 128  # anchors whose partial scores are held at a time
SALTS = 64  # keys under which a group's sizes are given
STEP = 8  # dimensions between two looks at the bounds
FEW = 0.05  # share of pairs still open from which they are computed one by one
LEVELS = (0.9, 0.7, 0.5, 0.35)  # first thresholds, as shares of the highest that can matter
LARGEST = 2**63 - 1
EXACT_BELOW = 2.0**52  # doubles hold sums up to here exactly


class Index:
    """One block's rows by dimension. ``low``: the lowest threshold to be asked, ``norm``: the largest norm of an anchor."""

    def __init__(self, rows: np.ndarray, low: float, norm: float):
        n, d = rows.shape
        self.dims = np.argsort(-np.square(rows).sum(0), kind="stable")
        ordered = rows[:, self.dims]
        rest = self._rest(ordered)
        if low > 0:
            stop = (rest * norm * (1 + 1e-9) >= low).sum(1)  # dimensions from here on cannot reach the threshold alone
            stop = np.minimum(-(-stop // STEP) * STEP, d)
        else:
            stop = np.full(n, d)
        self.order = np.argsort(-stop, kind="stable")
        self.stop = stop[self.order]
        self.rows = ordered[self.order]
        self.rest = rest[self.order]

    @staticmethod
    def _rest(ordered: np.ndarray) -> np.ndarray:
        """The norm of each row from dimension j on, for j from 0 to the number of dimensions."""
        squares = np.square(ordered)[:, ::-1].cumsum(1)[:, ::-1]
        return np.sqrt(np.hstack([squares, np.zeros((len(ordered), 1))]))

    def reach(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (anchor, row, score) whose score is at least the anchor's ``least``."""
        q = anchors[:, self.dims]
        left = self._rest(q)
        n, d = self.rows.shape
        need = least[:, None]
        if (least <= 0).any():
            return self._take(q, np.ones((len(q), n), bool), need)
        score = np.zeros((len(q), n))
        open_pairs = np.ones((len(q), n), bool)
        for j in range(0, d, STEP):
            c = int(np.searchsorted(-self.stop, -j, side="left"))  # rows indexed beyond dimension j
            if not c:
                break
            end = min(j + STEP, d)
            score[:, :c] += q[:, j:end] @ self.rows[:c, j:end].T
            at = np.minimum(self.stop, end)
            bound = self.rest[np.arange(n), at]
            more = left[:, np.full(n, end)] if c == n else left[:, at]
            open_pairs &= (score + more * bound) * (1 + 1e-9) + 1e-6 >= need
            if open_pairs.mean() <= FEW:
                break
        return self._take(q, open_pairs, need)

    def _take(self, q: np.ndarray, pairs: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if pairs.mean() > FEW:
            score = q @ self.rows.T
            a, b = np.nonzero(pairs & (score >= need))
            return a, self.order[b], score[a, b]
        a, b = np.nonzero(pairs)
        score = np.concatenate([np.zeros(0), *[np.einsum("ij,ij->i", q[a[k : k + 32768]], self.rows[b[k : k + 32768]]) for k in range(0, a.size, 32768)]])
        sure = score >= need[a, 0]
        return a[sure], self.order[b[sure]], score[sure]


class Exact:
    """The same question over numbers too large for doubles: every score in whole Python numbers."""

    def __init__(self, rows: np.ndarray):
        self.rows = np.array([[int(x) for x in r] for r in rows], dtype=object).reshape(rows.shape)

    def reach(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q = np.array([[int(x) for x in r] for r in anchors], dtype=object).reshape(anchors.shape)
        score = np.array([[sum(x * y for x, y in zip(a, b, strict=True)) for b in self.rows] for a in q], dtype=object).reshape(len(q), len(self.rows))
        score = np.array([[max(-LARGEST - 1, min(LARGEST, s)) for s in line] for line in score], dtype=object).reshape(score.shape)
        a, b = np.nonzero((score >= least[:, None]).astype(bool))
        return a, b, score[a, b]


def _most(rows: np.ndarray, anchors: np.ndarray) -> float:
    """No score, and no partial one, is larger."""
    return np.abs(anchors).sum(1).max(initial=0.0) * np.abs(rows).max(initial=0.0)


def index_of(rows: np.ndarray, anchors: np.ndarray, low: float) -> Index | Exact:
    if _most(rows, anchors) >= EXACT_BELOW:
        return Exact(rows)
    return Index(rows, low, float(np.sqrt(np.square(anchors).sum(1).max(initial=0.0))))


def first_of(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of each anchor's first ``most`` pairs: higher scores first, ties by smaller id."""
    order = np.lexsort((ids, -score, anchor))
    place = np.arange(order.size) - np.searchsorted(anchor[order], anchor[order], side="left")
    return order[place < most]


def best_rows(rows: np.ndarray, ids: np.ndarray, anchors: np.ndarray, own: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of each anchor's first ``most`` rows with another id than its own."""
    norms = np.sqrt(np.square(anchors).sum(1))
    top = float(np.sqrt(np.square(rows).sum(1).max(initial=0.0)))
    index = index_of(rows, anchors, LEVELS[-1] * top * float(norms.min(initial=np.inf)))
    open_rows, found = np.arange(len(anchors)), []
    for level in (*LEVELS, None):
        if not open_rows.size:
            break
        least = np.full(open_rows.size, -np.inf) if level is None else level * top * norms[open_rows]
        a, b, score = index.reach(anchors[open_rows], least)
        other = ids[b] != own[open_rows[a]]
        a, b, score = a[other], b[other], score[other]
        full = np.bincount(a, minlength=open_rows.size) >= most if level is not None else np.ones(open_rows.size, bool)
        keep = full[a]
        kept = first_of(a[keep], score[keep], ids[b[keep]], most)
        found.append((open_rows[a[keep][kept]], b[keep][kept], score[keep][kept]))
        open_rows = open_rows[~full]
    return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3


def windows_of(positive_scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest whole score s with low * p <= 100 * s <= high * p, for each positive score p."""
    p = [int(x) for x in positive_scores]
    return np.array([-(-low * x // 100) for x in p], dtype=object), np.array([high * x // 100 for x in p], dtype=object)


def fill_windows(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, own: np.ndarray, window_anchor: np.ndarray, least: np.ndarray, largest: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, row, score): the first ``most`` rows of another label in each window, from this block.

    ``window_anchor`` names each window's anchor (ascending). The threshold of an anchor starts near the top of its
    highest window and is lowered until all its windows are full or the bottom of the lowest is reached.
    """
    if _most(rows, anchors) >= EXACT_BELOW:
        return _fill_exactly(Exact(rows), ids, labels, anchors, own, window_anchor, least, largest, most)
    least, largest = least.astype(np.float64), largest.astype(np.float64)
    n = len(anchors)
    bottom, top = np.full(n, np.inf), np.full(n, -np.inf)
    np.minimum.at(bottom, window_anchor, least)
    np.maximum.at(top, window_anchor, largest)
    some = least <= largest
    wanted = np.zeros(n, bool)
    wanted[window_anchor[some]] = True
    begin = np.searchsorted(window_anchor, np.arange(n + 1))
    index = index_of(rows, anchors, float(bottom[wanted].min(initial=np.inf)))
    open_rows, found = np.flatnonzero(wanted), []
    for level in (*LEVELS, None):
        if not open_rows.size:
            break
        least_of = bottom[open_rows] if level is None else np.maximum(bottom[open_rows], level * top[open_rows])
        a, b, score = index.reach(anchors[open_rows], least_of)
        other = labels[b] != own[open_rows[a]]
        a, b, score = a[other], b[other], score[other]
        start = np.searchsorted(a, np.arange(open_rows.size + 1))
        full = np.ones(open_rows.size, bool)
        held = []
        for k, row in enumerate(open_rows):
            part = slice(start[k], start[k + 1])
            sorted_score = np.lexsort((ids[b[part]], -score[part]))
            b_part, s_part = b[part][sorted_score], score[part][sorted_score]
            mine = []
            for w in range(begin[row], begin[row + 1]):
                first = np.searchsorted(-s_part, -largest[w], side="left")
                stop = min(np.searchsorted(-s_part, -least[w], side="right"), first + most)
                full[k] &= stop - first >= most or least_of[k] <= least[w] or least[w] > largest[w]
                if stop > first:
                    mine.append((np.full(stop - first, w), b_part[first:stop], s_part[first:stop]))
            if full[k]:
                held += mine
        found += held
        open_rows = open_rows[~full]
    return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3


def _fill_exactly(index: Exact, ids, labels, anchors, own, window_anchor, least, largest, most):
    found = []
    for w, k in enumerate(window_anchor):
        _, b, score = index.reach(anchors[k : k + 1], least[w : w + 1])
        inside = np.flatnonzero((labels[b] != own[k]) & (score <= largest[w]).astype(bool))
        kept = sorted(inside.tolist(), key=lambda i: (-score[i], ids[b[i]]))[:most]
        found.append((np.full(len(kept), w), b[kept], score[kept]))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3


def _matrix(table: pa.Table) -> np.ndarray:
    return np.asarray(table.column("vector").combine_chunks().flatten(), np.float64).reshape(table.num_rows, -1)


def _whole(scores: np.ndarray) -> pa.Array:
    return pa.array([int(max(-LARGEST - 1, min(LARGEST, int(s)))) for s in scores], pa.int64())


def _groups(batches: Iterator) -> Iterator[tuple[pa.Table, pa.Table]]:
    """(rows of a block, anchors of a pack) for each key that has both."""
    for _, parts in runs(batches, lambda b: np.array([f"{k['g']} {k['block']} {k['pack']}" for k in b.column("key").to_pylist()])):
        table = pa.Table.from_batches(parts).combine_chunks()
        side = table.column("side").to_numpy()
        cut = int(np.searchsorted(side, 1))
        if 0 < cut < table.num_rows:
            yield table.slice(0, cut), table.slice(cut)


def _positives(batches, most: int):
    for rows, anchors in _groups(batches):
        x, ids = _matrix(rows), rows.column("id").to_numpy()
        for k in range(0, anchors.num_rows, AT_ONCE):
            part = anchors.slice(k, AT_ONCE)
            own = part.column("id").to_numpy()
            a, b, score = best_rows(x, ids, _matrix(part), own, most)
            yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(part.column("mark").to_numpy()[a]), pa.array(ids[b]), _whole(score)], names=["anchor_id", "mark", "positive_id", "positive_score"])


def _negatives(batches, most: int, low: int, high: int):
    for rows, anchors in _groups(batches):
        x, ids = _matrix(rows), rows.column("id").to_numpy()
        names = {label: k for k, label in enumerate(rows.column("label").unique().to_pylist())}
        labels = np.array([names[v] for v in rows.column("label").to_pylist()])
        for k in range(0, anchors.num_rows, AT_ONCE):
            part = anchors.slice(k, AT_ONCE)
            own = np.array([names.get(v, -1) for v in part.column("label").to_pylist()])
            places = part.column("places").combine_chunks()
            scores = part.column("scores").combine_chunks().flatten().to_numpy()
            of = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
            least, largest = windows_of(scores, low, high)
            w, b, score = fill_windows(x, ids, labels, _matrix(part), own, of, least, largest, most)
            place = places.flatten().to_numpy()
            anchor, mark = part.column("id").to_numpy()[of[w]], part.column("mark").to_numpy()[of[w]]
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(mark), pa.array(place[w]), pa.array(ids[b]), _whole(score)], names=["anchor_id", "mark", "place", "negative_id", "negative_score"])


def _paired(rows: DataFrame, anchors: DataFrame, groups: list[str], extra: list[str]) -> DataFrame:
    """Blocks of rows and packs of anchors of one group under one key, rows first."""
    def key(block: Column, pack: Column) -> Column:
        return F.struct(F.concat_ws("|", *[F.col(g).cast("string") for g in groups]).alias("g"), block.cast("int").alias("block"), pack.cast("int").alias("pack"))

    def part(count: str, most: int, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id", "mark"), F.ceil(F.col(count) / most))

    def each(count: str, most: int) -> Column:
        return F.explode(F.sequence(F.lit(0), (F.ceil(F.col(count) / most) - 1).cast("int")))

    n_rows = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_rows"))
    n_anchors = anchors.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_anchors"))
    # each group's sizes meet its rows under several keys, as one group may hold most rows
    sizes = n_rows.join(n_anchors, groups).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(F.lit(9), "id", "mark"), F.lit(SALTS)).cast("int")
    columns = ["id", "mark", "label", "vector"]
    left = rows.select(*columns, *[g for g in groups if g not in columns], *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in extra])
    left = left.withColumn("_salt", salt).join(sizes, [*groups, "_salt"]).withColumn("_other", each("n_anchors", PACK)).withColumn("side", F.lit(0))
    left = left.withColumn("key", key(part("n_rows", BLOCK, 3), F.col("_other")))
    right = anchors.withColumn("_salt", salt).join(sizes, [*groups, "_salt"]).withColumn("_other", each("n_rows", BLOCK)).withColumn("side", F.lit(1))
    right = right.withColumn("key", key(F.col("_other"), part("n_anchors", PACK, 5)))
    shape = ["key", "side", *columns, *extra]
    both = left.select(*shape).unionByName(right.select(*shape))
    return both.repartition(partitions_for(rows.sparkSession), "key").sortWithinPartitions("key", "side", "id", "mark")


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """``id, mark, label, vector (whole numbers as doubles), dims``: the rows that take part, repeated ones once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(finite & (F.size("vector") > 0))
    scaled = F.transform("vector", lambda x: x * F.lit(float(scale)))
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y))  # larger doubles are whole
    rows = rows.withColumn("vector", whole)
    return rows.withColumn("mark", F.xxhash64("label", "vector")).withColumn("dims", F.size("vector")).dropDuplicates(["id", "mark"])


def mine(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256.0,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchors`` (on ``id``) picks.

    A score is the inner product of ``floor(scale * x)``. An anchor's positives are its first ``positives`` rows of the same
    label, the negatives of a positive its first ``negatives`` rows of another label with low * positive score <=
    100 * score <= high * positive score; higher scores come first, then smaller ids.

    Rows without id, label or vector, and those with an empty vector or a null or non-finite component, take no part; rows equal in
    id, label and vector are one row. Rows that share an id but not the rest are rows of their own, of which none is
    a positive of another; each of them that is an anchor is mined by itself. Vectors of different lengths never meet.
    A label of one row has no positives, and a table without anchors or rows gives an empty result. Other columns are not read.
    Every pair of a pack of anchors and a block of rows is looked at, so the work is anchors times rows.
    """
    rows = stored(usable_rows(vectors, id_col, vector_col, label_col, scale), "mine-rows")
    picked = rows.filter(anchors)
    schema = "anchor_id long, mark long, positive_id long, positive_score long"
    near = _paired(rows, picked, ["label", "dims"], []).mapInArrow(lambda batches: _positives(batches, positives), schema)
    order = Window.partitionBy("anchor_id", "mark").orderBy(F.col("positive_score").desc(), "positive_id")
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    near = stored(near, "mine-positives")
    asked = near.groupBy("anchor_id", "mark").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("asked"))
    asked = asked.select(F.col("anchor_id").alias("id"), "mark", F.col("asked.place").alias("places"), F.col("asked.positive_score").alias("scores"))
    wide = picked.join(asked, ["id", "mark"])
    schema = "anchor_id long, mark long, place int, negative_id long, negative_score long"
    far = _paired(rows, wide, ["dims"], ["places", "scores"]).mapInArrow(lambda batches: _negatives(batches, negatives, low, high), schema)
    order = Window.partitionBy("anchor_id", "mark", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    far = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return far.join(near, ["anchor_id", "mark", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
