"""Token ids in wavelet-matrix files, and their reader.

A shard holds the ids of consecutive documents, each closed by an end id. Its bits are stored plane by
plane, most significant first; each plane orders the ids by the bits above it, zeros before ones, so the
n-th id, the occurrences of an id and their number follow from rank and select on the planes alone.

File format of a shard (one row of the written table, column ``body``), all integers little-endian:

    8 bytes magic and version, u64 ids, u32 documents, u32 planes, u32 bits per rank block,
    u64 zeros of each plane, i64 document ids, u64 end offsets, u8 null mark per document, then
    one zstd frame per plane (u64 length before it) of its u32 block ranks and packed bits.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.byte_ids import ByteIds
from tallywatch.llm.tables import map_batches, partitions_for, text_or_empty

MAGIC = b"WAVEIDS1"
HEADER = struct.Struct("<8sQIII")
RANK_BITS = 1024  # bits per rank block: 4 bytes of rank for 128 bytes of plane
SHARD_IDS = 1 << 20  # a shard is closed once it holds so many ids


@dataclass
class Plane:
    zeros: int
    ranks: np.ndarray  # ones before each block
    packed: np.ndarray

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = at // RANK_BITS
        out = self.ranks[block].astype(np.int64)
        first = block * (RANK_BITS // 8)
        for k in range(at.size):
            lo, hi = first[k], at[k] // 8
            out[k] += int(POPCOUNT[self.packed[lo:hi]].sum())
            if rest := at[k] % 8:
                out[k] += int(POPCOUNT[self.packed[hi] >> (8 - rest)])
        return out

    def bit(self, at: int) -> int:
        return int(self.packed[at >> 3]) >> (7 - (at & 7)) & 1

    def find(self, bit: int, nth: np.ndarray) -> np.ndarray:
        """Positions of the ``nth`` (from 0, ascending) occurrences of ``bit``: the block by its rank, then inside it."""
        before = self.ranks.astype(np.int64)
        if not bit:
            before = np.arange(before.size) * RANK_BITS - before
        blocks, out, step = np.searchsorted(before, nth, "right") - 1, np.empty(nth.size, np.int64), RANK_BITS // 8
        for block in np.unique(blocks):
            mine = blocks == block
            inside = np.flatnonzero(np.unpackbits(self.packed[block * step : (block + 1) * step]) == bit)
            out[mine] = block * RANK_BITS + inside[nth[mine] - before[block]]
        return out


POPCOUNT = np.array([bin(b).count("1") for b in range(256)], np.int64)


def _zeros_ones(bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of either bit: such lists cost the same whatever the bits are, while masks slow down where they mix."""
    return np.flatnonzero(~bit), np.flatnonzero(bit)


class WaveletMatrix:
    """Rank and select over the planes of one shard."""

    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes = n, planes

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        """``ids``: unsigned integers below ``2 ** width``."""
        planes, now = [], ids
        for shift in range(width - 1, -1, -1):
            bit = (now & now.dtype.type(1 << shift)) != 0
            packed = np.packbits(bit)
            padded = np.zeros(-(-packed.size // (RANK_BITS // 8)) * (RANK_BITS // 8) + RANK_BITS // 8, np.uint8)
            padded[: packed.size] = packed
            each = np.bitwise_count(padded.view(np.uint64)).reshape(-1, RANK_BITS // 64).sum(axis=1, dtype=np.int64)
            ranks = np.zeros(each.size, np.uint32)
            np.cumsum(each[:-1], out=ranks[1:], dtype=np.uint32)
            planes.append(Plane(bit.size - int(np.count_nonzero(bit)), ranks, padded))
            if not shift:
                break  # nothing reads the order that the last plane makes
            zero, one = _zeros_ones(bit)
            then = np.empty_like(now)
            now.take(zero, out=then[: zero.size], mode="clip")
            now.take(one, out=then[zero.size :], mode="clip")
            now = then
        return cls(ids.size, planes)

    def all(self, dtype=np.uint32) -> np.ndarray:
        """Every id in order, by undoing the planes from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else dtype
        low = np.zeros(self.n, kind)
        for k, plane in enumerate(reversed(self.planes)):
            bit = np.unpackbits(plane.packed, count=self.n).view(bool)
            if not k:
                low = bit.astype(kind)
                continue
            zero, one = _zeros_ones(bit)
            out = np.empty(self.n, kind)
            out[zero] = low[: plane.zeros]
            out[one] = low[plane.zeros :] | kind(1 << k)
            low = out
        return low.astype(dtype, copy=False)

    def access(self, at: int) -> int:
        value = 0
        for plane in self.planes:
            bit = plane.bit(at)
            ones = int(plane.ones(np.array([at]))[0])
            at = plane.zeros + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int) -> tuple[int, int]:
        """Where the last order holds the occurrences of ``token``."""
        lo, hi, width = 0, self.n, len(self.planes)
        if token >> width:
            return 0, 0
        for k, plane in enumerate(self.planes):
            a, b = map(int, plane.ones(np.array([lo, hi])))
            lo, hi = (plane.zeros + a, plane.zeros + b) if token >> (width - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int) -> int:
        lo, hi = self._range(token)
        return hi - lo

    def occurrences(self, token: int) -> np.ndarray:
        """Ascending positions of ``token``."""
        lo, hi = self._range(token)
        at, width = np.arange(lo, hi), len(self.planes)
        for k in range(width - 1, -1, -1):
            plane = self.planes[k]
            at = plane.find(1, at - plane.zeros) if token >> (width - 1 - k) & 1 else plane.find(0, at)
        return at


def write_shard(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray, width: int = 16) -> bytes:
    matrix = WaveletMatrix.build(ids, width)
    out = [
        HEADER.pack(MAGIC, ids.size, len(doc_ids), width, RANK_BITS),
        np.array([p.zeros for p in matrix.planes], "<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.asarray(ends, "<u8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(),
    ]
    pack = zstandard.ZstdCompressor(level=1).compress
    for plane in matrix.planes:
        body = pack(plane.ranks.astype("<u4").tobytes() + plane.packed.tobytes())
        out += [struct.pack("<Q", len(body)), body]
    return b"".join(out)


class Shard:
    """A written shard: its documents and its wavelet matrix."""

    def __init__(self, body: bytes):
        magic, n, docs, width, rank_bits = HEADER.unpack_from(body)
        if magic != MAGIC or rank_bits != RANK_BITS:
            raise ValueError("not a shard of this version")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, count, at)
            at += out.nbytes
            return out

        zeros = take("<u8", width)
        ids, self.ends, null = take("<i8", docs), take("<u8", docs).astype(np.int64), take("u1", docs)
        self.doc_ids = [None if gone else int(d) for d, gone in zip(ids, null, strict=True)]
        blocks, unpack, planes = -(-(-(-n // 8)) // (RANK_BITS // 8)) + 1, zstandard.ZstdDecompressor().decompress, []
        for z in zeros:
            (size,) = struct.unpack_from("<Q", body, at)
            raw = unpack(body[at + 8 : at + 8 + size])
            at += 8 + size
            planes.append(Plane(int(z), np.frombuffer(raw, "<u4", blocks), np.frombuffer(raw, "u1", offset=4 * blocks)))
        self.matrix = WaveletMatrix(n, planes)


@lru_cache(maxsize=2)
def _encoder(path: str) -> ByteIds:
    return ByteIds(path)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write their ids as shards below ``path``, in ascending id order.

    One shuffle deals the texts into ranges of ids; each task encodes its range in order and closes a shard
    whenever it holds ``shard_ids`` ids, so a task holds one shard and one batch of texts at a time. A null
    text has no ids but the end id. Documents without an id come first; rows with the same id are ordered
    by a hash of their text, which also lets many of them spread over tasks. A document is never split: a longer one makes a longer shard. Other columns are not read.
    """

    def run(batches):
        encoder, closing = _encoder(tokenizer), np.array([end_id], "<u2").tobytes()
        open_shard = _OpenShard()
        for batch in batches:
            for part, doc, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                open_shard.add(part.as_py(), doc.as_py(), encoder.encode(text.as_py()) + closing)
                if open_shard.ids >= shard_ids:
                    yield open_shard.close()
        if open_shard.docs:
            yield open_shard.close()

    parts = partitions_for(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts, "doc", "tie").sortWithinPartitions(F.col("doc").asc_nulls_first(), "tie", "text")
    dealt.select(F.spark_partition_id().alias("part"), "doc", "text").mapInArrow(run, SHARD_SCHEMA).write.option("compression", "none").parquet(path)


SHARD_SCHEMA = "part int, shard int, n_docs int, n_ids long, body binary"
SHARD_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("body", pa.binary())])


class _OpenShard:
    """The documents of a range that are not yet written."""

    def __init__(self):
        self.shard, self.docs, self.bodies, self.sizes, self.ids = 0, [], [], [], 0

    def add(self, part: int, doc: int | None, ids: bytes) -> None:
        self.part = part
        self.docs.append(doc)
        self.bodies.append(ids)
        self.sizes.append(len(ids) // 2)
        self.ids += len(ids) // 2

    def close(self) -> pa.RecordBatch:
        body = write_shard(np.frombuffer(b"".join(self.bodies), "<u2"), self.docs, np.cumsum(self.sizes))
        row = pa.RecordBatch.from_pylist([{"part": self.part, "shard": self.shard, "n_docs": len(self.docs), "n_ids": self.ids, "body": body}], SHARD_ARROW)
        self.shard, self.docs, self.bodies, self.sizes, self.ids = self.shard + 1, [], [], [], 0
        return row


DOC_SCHEMA = "doc_id long, part int, shard int, local_start long, n_tokens long, ids binary"


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the shards below ``path``, one row each; ``ids`` are little-endian 32-bit integers.

    ``local_start`` counts from the start of the shard; ``with_start`` turns it into a global position.
    """

    def run(batch):
        for part, number, body in zip(*(batch.column(k) for k in range(3)), strict=True):
            shard = Shard(body.as_py())
            ids = shard.matrix.all()
            starts = np.concatenate([[0], shard.ends])
            offsets, n = pa.array(starts * 4, pa.int32()), len(shard.doc_ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array([part.as_py()] * n, pa.int32()),
                    pa.array([number.as_py()] * n, pa.int32()),
                    pa.array(starts[:-1], pa.int64()),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.Array.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(ids.astype("<u4"))]),
                ],
                names=["doc_id", "part", "shard", "local_start", "n_tokens", "ids"],
            )

    return map_batches(_shards(spark, path).select("part", "shard", "body"), DOC_SCHEMA, lambda: run)


def with_start(docs: DataFrame, path: str) -> DataFrame:
    """Replace ``part``, ``shard`` and ``local_start`` by ``start``, the number of ids of all documents before.

    Only the shards' counts are summed: within each range of ids, and then over one row for each range.
    """
    counts = _shards(docs.sparkSession, path).select("part", "shard", "n_ids")
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = F.coalesce(F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = counts.withColumn("shard_start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).join(parts.select("part", earlier.alias("part_start")), "part")
    base = base.select("part", "shard", (F.col("part_start") + F.col("shard_start")).alias("shard_start"))
    joined = docs.join(base, ["part", "shard"])
    return joined.withColumn("start", F.col("shard_start") + F.col("local_start")).drop("part", "shard", "shard_start", "local_start")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)
