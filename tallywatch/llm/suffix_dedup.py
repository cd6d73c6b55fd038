"""Removing every byte covered by a string of ``length`` bytes that starts more than once in the corpus.

Equal strings of that length hold equal grams at equal places, so each string is filed under the gram with
the smallest hash in it (the leftmost of equals): a suffix bucket. Neighbouring strings mostly share that
gram and form one region of text, cut out once. Strings whose gram occurs once are done. The regions of a
gram meet in one task, which sorts their suffixes bucket by bucket with a difference cover (``suffix_sort``)
and marks those that agree with a neighbour on ``length`` bytes.

Regions with the same content are merged and counted before they move, so a passage copied a million times
is sorted once. A gram with more than ``crowd`` different regions is not sorted in one task: its regions are
cut to short runs of strings, which are filed under what all strings of a run have in common, and what is
left in company is counted string by string.
"""

from __future__ import annotations

from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.links import runs
from tallywatch.llm.suffix_sort import PERIOD, Block
from tallywatch.llm.tables import map_batches, packed, partitions_for, stored

PIECE = 1 << 20  # string starts looked at together; their place fits the low bits of a hash
LOW = np.uint64((1 << 21) - 1)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
STEP = 8  # strings in a run of a crowded gram


@dataclass(frozen=True)
class Repeats:
    """``length`` of repeated strings and of the ``gram`` they are filed under, in bytes; bounds of a task's work."""

    length: int = 200
    gram: int = 32
    crowd: int = 32_768  # different regions of a gram that one task sorts
    block: int = 1 << 20  # bytes of regions that are sorted together

    def __post_init__(self):
        if self.gram & (self.gram - 1) or not PERIOD < self.length < 256 or self.gram >= self.length - STEP:
            raise ValueError("the gram is a power of two, and the length between 58 and 255 holds it")


class Grams:
    """Where a text's strings are filed."""

    def __init__(self, repeats: Repeats, seed: int = 4):
        self.repeats = repeats
        self.table = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """Of the gram at each place, by doubling."""
        out, size, power = self.table[data], 1, SPREAD
        while size < self.repeats.gram:
            out = out[:-size] * power + out[size:]
            size, power = 2 * size, np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
        return out

    def file(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Regions of ``text``: gram, first string start, number of strings, and from that start to the gram."""
        length = self.repeats.length
        found = []
        for base in range(0, len(text) - length + 1, PIECE):
            data = np.frombuffer(text, np.uint8, min(PIECE + length - 1, len(text) - base), base)
            grams = self.hashes(data)
            low = (grams & ~LOW) | np.arange(grams.size, dtype=np.uint64)
            size, need = 1, length - self.repeats.gram + 1
            while 2 * size <= need:
                low = np.minimum(low[:-size], low[size:])
                size *= 2
            if need > size:
                low = np.minimum(low[: size - need], low[need - size :])
            at = (low & LOW).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            found.append((grams[at[first]].view(np.int64), first + base, np.diff(np.append(first, at.size)), at[first] - first))
        if not found:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _document(docs: DataFrame, id_col: str, text_col: str, *carried: str) -> DataFrame:
    """``doc, mark, text``: a 128-bit name of the id (or of none) and the text together, and the text's bytes."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    doc, mark = (F.xxhash64(F.lit(k), F.col(id_col).cast("long"), F.col(id_col).isNull(), text) for k in (1, 2))
    return docs.select(*carried, doc.alias("doc"), mark.alias("mark"), text.alias("text"))


FILED = "gram long, doc long, mark long, place long, known boolean, deal long"
COMPANY = "gram long, doc long, mark long, place long"


def _file(rows: DataFrame, repeats: Repeats) -> DataFrame:
    """A row for each region. ``place`` packs start, strings and gram offset.

    Of identical rows in a batch one is filed, all of it known to repeat. A gram that a batch of texts holds more than once is known to repeat: one such row goes where the gram is
    dealt, as a witness for other tasks, and the others anywhere. So no gram fills a task.
    """

    def start():
        grams = Grams(repeats)

        def step(batch):
            gram, doc, mark, place, many = [], [], [], [], []
            copies = Counter(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            names = dict.fromkeys(copies)
            for name, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), batch.column(2), strict=True):
                if name not in names:
                    continue
                del names[name]
                g, first, count, offset = grams.file(text.as_buffer())
                gram.append(g)
                doc.append(np.full(g.size, name[0], np.int64))
                mark.append(np.full(g.size, name[1], np.int64))
                place.append(first << 16 | count << 8 | offset)
                many.append(np.full(g.size, copies[name] > 1))
            gram, doc, mark, place, many = (np.concatenate(x) for x in (gram, doc, mark, place, many))
            order = np.argsort(gram, kind="stable")
            ordered = gram[order]
            same = ordered[1:] == ordered[:-1]
            known, later = many, np.zeros(gram.size, bool)
            known[order[1:][same]] = known[order[:-1][same]] = True
            later[order[1:][same]] = True
            deal = np.where(later, (doc.view(np.uint64) * SPREAD + place.view(np.uint64)).view(np.int64), gram)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (gram, doc, mark, place, known, deal)], names=["gram", "doc", "mark", "place", "known", "deal"])

        return step

    return map_batches(rows.select("doc", "mark", "text"), FILED, start, rows=None)


def _company(batches):
    """Rows known to repeat, and those whose gram the row before or after shares."""
    names = ["gram", "doc", "mark", "place"]
    last, last_kept, held = None, True, None
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, known = batch.column(0).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
        same = gram[1:] == gram[:-1]
        keep = known | np.append(same, False) | np.concatenate([[gram[0] == last], same])
        if held is not None and gram[0] == last and not last_kept:
            yield held
        held, last, last_kept = pa.RecordBatch.from_arrays([batch.column(k).slice(batch.num_rows - 1) for k in range(4)], names=names), gram[-1], keep[-1]
        kept = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(kept) for k in range(4)], names=names)


REGION = "gram long, name_a long, name_b long, span int, offset int, n long, content binary, found binary"


def _cut(rows: DataFrame, repeats: Repeats) -> DataFrame:
    """Regions of a batch of texts with their content, equal ones merged; ``found``: where they were (doc, mark, start).

    ``n`` counts every identical row, ``found`` names them once.
    """
    more = repeats.length - 1

    def step(batch):
        regions: dict[bytes, list] = {}
        edges, filed = batch.column(3).offsets.to_numpy(), batch.column(3).flatten()  # objects for one text's regions at a time
        grams, places = (filed.field(name).to_numpy() for name in ("gram", "place"))
        edges = edges - edges[0]
        for k, (doc, mark, text, copies) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(4).to_pylist(), strict=True)):
            body, own = text.as_buffer(), slice(edges[k], edges[k + 1])
            for gram, place in zip(grams[own].tolist(), places[own].tolist(), strict=True):
                start, span, offset = place >> 16, place >> 8 & 0xFF, place & 0xFF
                content = body[start : start + span + more].to_pybytes()
                name = xxhash.xxh3_128_digest(content + bytes([offset]))
                known = regions.get(name)
                if known is None:
                    known = regions[name] = [gram, span, offset, content, array("q"), 0]
                known[4].extend((doc, mark, start))
                known[5] += copies
        names = np.frombuffer(b"".join(regions), "<i8").reshape(-1, 2)
        values = list(regions.values())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([v[0] for v in values], pa.int64()),
                pa.array(names[:, 0]),
                pa.array(names[:, 1]),
                pa.array([v[1] for v in values], pa.int32()),
                pa.array([v[2] for v in values], pa.int32()),
                pa.array([v[5] for v in values], pa.int64()),
                pa.array([v[3] for v in values], pa.binary()),
                pa.array([v[4].tobytes() for v in values], pa.binary()),
            ],
            names=["gram", "name_a", "name_b", "span", "offset", "n", "content", "found"],
        )

    return map_batches(rows, REGION, lambda: step, rows=None)


MARKED = "name_a long, name_b long, marks binary"


def _sort(batches, repeats: Repeats):
    """``marks``: a byte for each string of a region, 1 if it repeats; regions without any are left out."""
    waiting, held = [], 0
    for _, parts in runs(batches, lambda b: b.column(0).to_numpy()):
        table = pa.Table.from_batches(parts)
        names = np.column_stack([table.column("name_a").to_numpy(), table.column("name_b").to_numpy()])
        first = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]).any(axis=1)]))
        count = np.add.reduceat(table.column("n").to_numpy(), first)
        if first.size == 1 and count[0] == 1:
            continue
        one = table.take(pa.array(first))
        waiting.append((names[first], count, one.column("span").to_numpy(), one.column("offset").to_numpy(), one.column("content").to_pylist()))
        held += sum(map(len, waiting[-1][4]))
        if held >= repeats.block:
            yield _marks(waiting, repeats)
            waiting, held = [], 0
    if waiting:
        yield _marks(waiting, repeats)


def _marks(grams: list[tuple], repeats: Repeats) -> pa.RecordBatch:
    """Sort the suffixes of the regions of some grams, in one block; a bucket is a gram and a distance to it."""
    names = np.concatenate([g[0] for g in grams])
    many = np.concatenate([g[1] for g in grams]) > 1
    span, offset = (np.concatenate([g[k] for g in grams]).astype(np.int64) for k in (2, 3))
    alone = np.concatenate([np.full(len(g[1]), len(g[1]) == 1) for g in grams])
    which = np.repeat(np.arange(len(grams)), [len(g[1]) for g in grams])
    contents = [c for g in grams for c in g[4]]
    begin = np.concatenate([[0], np.cumsum([len(c) for c, lone in zip(contents, alone, strict=True) if not lone])])
    at_region, chosen = np.flatnonzero(~alone), span[~alone]
    inside = np.arange(chosen.sum()) - np.repeat(np.cumsum(chosen) - chosen, chosen)
    owner = np.repeat(at_region, chosen)
    repeated = np.zeros(0, bool)
    if owner.size:
        block = Block(b"".join(c for c, lone in zip(contents, alone, strict=True) if not lone))
        repeated = block.repeated(np.repeat(begin[:-1], chosen) + inside, which[owner] * 256 + offset[owner] - inside, repeats.length)
    ends = np.cumsum(span)
    marks = np.repeat(many, span)
    marks[np.repeat((ends - span)[~alone], chosen) + inside] |= repeated
    some = [k for k, (a, b) in enumerate(zip(ends - span, ends, strict=True)) if marks[a:b].any()]
    bodies = [marks[ends[k] - span[k] : ends[k]].tobytes() for k in some]
    return pa.RecordBatch.from_arrays([pa.array(names[some, 0]), pa.array(names[some, 1]), pa.array(bodies, pa.binary())], names=["name_a", "name_b", "marks"])


def _runs_of_crowd(rows: DataFrame, repeats: Repeats) -> DataFrame:
    """Regions cut to runs of strings on a grid that starts at the gram, named by the bytes all strings of the run share.

    Equal strings stand at equal distances to their gram, so in runs of the same place with the same shared bytes.
    """

    def step(batch):
        out = []
        for row in batch.to_pylist():
            for near in range(max(0, row["offset"] - row["span"] + 1) // STEP, row["offset"] // STEP + 1):
                # The run's strings start near * STEP .. near * STEP + STEP - 1 bytes before the gram.
                lo, hi = row["offset"] - near * STEP - STEP + 1, row["offset"] - near * STEP
                lo_in, hi_in = max(lo, 0), min(hi, row["span"] - 1)
                shared = row["content"][hi : lo + repeats.length] if lo >= 0 else row["content"][hi : max(hi, lo + repeats.length)]
                core = xxhash.xxh3_128_digest(shared, seed=near)
                out.append((row["name_a"], row["name_b"], row["n"], lo_in, hi_in - lo_in + 1, core, row["content"][lo_in : hi_in + repeats.length]))
        a, b, n, lo, count, core, content = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()), pa.array(lo, pa.int32()), pa.array(count, pa.int32()), pa.array(core, pa.binary()), pa.array(content, pa.binary())],
            names=["name_a", "name_b", "n", "lo", "count", "core", "content"],
        )

    return map_batches(rows.select("name_a", "name_b", "n", "span", "offset", "content"), "name_a long, name_b long, n long, lo int, count int, core binary, content binary", lambda: step)


def _marks_of_crowd(rows: DataFrame, repeats: Repeats) -> DataFrame:
    """The exact way for crowded grams: strings are counted by their bytes, with partial sums before any shuffle."""
    cut = stored(_runs_of_crowd(rows, repeats), "crowd")
    company = cut.groupBy("core").agg(F.sum("n").alias("in_core")).filter("in_core > 1")
    string = F.substring(F.col("content"), F.col("k") + 1, F.lit(repeats.length))
    strings = cut.join(company.select("core"), "core").select("name_a", "name_b", "n", "lo", "core", F.posexplode(F.sequence(F.lit(0), F.col("count") - 1)).alias("p", "k"), "content")
    strings = strings.select("name_a", "name_b", "n", (F.col("lo") + F.col("k")).alias("at"), F.xxhash64("core", string).alias("h1"), F.xxhash64(string, "core").alias("h2"))
    counts = strings.groupBy("h1", "h2").agg(F.sum("n").alias("m")).filter("m > 1").select("h1", "h2")
    return strings.join(counts, ["h1", "h2"]).select("name_a", "name_b", "at")


def spans(docs: DataFrame, repeats: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, mark, starts array<binary>``: the first bytes of repeated strings, packed as (first, last) pairs."""
    spark = docs.sparkSession
    parts = partitions_for(spark)
    rows = _document(docs, id_col, text_col)
    filed = _file(rows, repeats).repartition(parts, "deal").sortWithinPartitions("gram").mapInArrow(_company, COMPANY)
    per_doc = filed.groupBy("doc", "mark").agg(F.collect_set(F.struct("gram", "place")).alias("filed"))
    # A text stands for its identical rows: those come to one task by the join already, so no text moves twice.
    with_text = rows.join(per_doc, ["doc", "mark"]).groupBy("doc", "mark").agg(F.first("text").alias("text"), F.first("filed").alias("filed"), F.count(F.lit(1)).alias("copies"))
    regions = stored(_cut(with_text, repeats), "regions")

    crowded = regions.groupBy("gram").agg(F.count(F.lit(1)).alias("crowd")).filter(F.col("crowd") > repeats.crowd).select("gram")
    crowded = stored(crowded, "crowded")
    columns = ["gram", "name_a", "name_b", "span", "offset", "n", "content"]
    if crowded.isEmpty():
        calm, some = regions.select(*columns), None
    else:
        calm, some = regions.select(*columns).join(crowded, "gram", "left_anti"), regions.select(*columns).join(crowded, "gram")
    marked = calm.repartition(parts, "gram").sortWithinPartitions("gram", "name_a", "name_b").mapInArrow(lambda b: _sort(b, repeats), MARKED)
    found = _places(regions.join(marked, ["name_a", "name_b"]).select("found", "marks"))
    if some is not None:
        one = _marks_of_crowd(some, repeats).groupBy("name_a", "name_b").agg(F.array_sort(F.collect_set("at")).alias("at"))
        found = found.unionByName(_places_of_crowd(regions.join(one, ["name_a", "name_b"]).select("found", "at")))
    return found.groupBy("doc", "mark").agg(F.collect_list("starts").alias("starts"))


def _pairs(marks: np.ndarray) -> np.ndarray:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).view(np.int8)))
    return np.column_stack([edges[::2], edges[1::2] - 1])


PLACES = "doc long, mark long, starts binary"


def _emit(found: list[bytes], pairs: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each document of a batch, with all its pairs."""
    by: dict[tuple[int, int], list[np.ndarray]] = {}
    for body, pair in zip(found, pairs, strict=True):
        for doc, mark, start in np.frombuffer(body, "<i8").reshape(-1, 3).tolist():
            by.setdefault((doc, mark), []).append(pair + start)
    return pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in by], pa.int64()), pa.array([m for _, m in by], pa.int64()), pa.array([np.concatenate(v).astype("<i8").tobytes() for v in by.values()], pa.binary())], names=["doc", "mark", "starts"]
    )


def _places(rows: DataFrame) -> DataFrame:
    def step(batch):
        return _emit(batch.column(0).to_pylist(), [_pairs(np.frombuffer(m.as_buffer(), np.uint8).astype(bool)) for m in batch.column(1)])

    return map_batches(rows, PLACES, lambda: step, rows=None)


def _places_of_crowd(rows: DataFrame) -> DataFrame:
    def step(batch):
        return _emit(batch.column(0).to_pylist(), [np.repeat(np.array(a, np.int64)[:, None], 2, axis=1) for a in batch.column(1).to_pylist()])

    return map_batches(rows, PLACES, lambda: step, rows=None)


def removed_runs(starts: list[bytes], length: int) -> np.ndarray:
    """Maximal runs of covered bytes, as (start, end) rows."""
    pairs = np.frombuffer(b"".join(starts), "<i8").reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1]) + length
    first = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    at = np.flatnonzero(first)
    return np.column_stack([pairs[at, 0], reach[np.append(at[1:], len(pairs)) - 1]])


CUT = "n_bytes long, removed array<struct<start: long, end: long>>, kept binary"


def without_repeats(docs: DataFrame, repeats: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``), ``n_bytes``, ``removed`` (runs of byte offsets) and ``kept`` (bytes) for every row.

    Texts are their UTF-8 bytes; a null text is empty. Strings never cross rows, and every row is a document
    of its own: rows with equal texts lose whatever is as long as a string. Rows shorter than a string stay
    whole. An empty table gives an empty one.
    """
    found = spans(docs, repeats, id_col, text_col)

    def step(batch):
        n_bytes, lists, kept = [], [], []
        for text, starts in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            body = text.as_py()
            gone = removed_runs(starts, repeats.length).tolist() if starts else []
            edges = [0, *(x for run in gone for x in run), len(body)]
            n_bytes.append(len(body))
            lists.append([{"start": a, "end": b} for a, b in gone])
            kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        runs_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(lists, runs_type), pa.array(kept, pa.binary())], names=["row", "n_bytes", "removed", "kept"])

    rows = packed(docs).select("row", *(F.col(f"row.`{c}`").alias(f"row_{k}") for k, c in enumerate((id_col, text_col))))
    joined = _document(rows, "row_0", "row_1", "row").join(found, ["doc", "mark"], "left").select("row", "text", "starts")
    return map_batches(joined, StructType([joined.schema["row"], *StructType.fromDDL(CUT)]), lambda: step)


def n_removed(removed: str = "removed") -> Column:
    return F.aggregate(F.col(removed), F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
