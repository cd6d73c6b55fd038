"""Quality scores from compression: a text is like what its compressor was primed with.

Two zstandard dictionaries are built from labelled texts, one from good and one from bad ones. A text is cut
into chunks, each compressed with both; the difference of the two sizes, normalised by the text's size, is
large where good text explains it better. A logistic curve, fitted on other labelled rows, turns the
difference and the compressed share (which tells repetitive text) into a probability.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.tables import map_batches, packed, text_or_empty

CHUNK = 4096  # bytes compressed at once, so that a dictionary matters throughout a long text
LEVEL = 3
DICTIONARY = 64 * 1024


@dataclass(frozen=True)
class Sample:
    """Bounds of what is learned from: labelled rows of each class, and chunks taken of each row for the
    dictionaries (evenly spaced)."""

    rows: int = 3000
    chunks: int = 6


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...] = ()  # of the inputs, the intercept last


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def chunks(text: bytes) -> list[bytes]:
    return [text[k : k + CHUNK] for k in range(0, len(text), CHUNK)]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def _compressor(content: bytes):
    if not content:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
    primed = zstandard.ZstdCompressionDict(content)
    primed.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_dict_id=False).compress


SIZES = "n_bytes long, good_bytes long, bad_bytes long"


def with_sizes(rows: DataFrame, model: Model) -> DataFrame:
    """``row`` and the bytes of ``text`` in ``row, text``: plain, and compressed with either dictionary; whole texts."""

    def start():
        good, bad = _compressor(model.good), _compressor(model.bad)

        def step(batch):
            sizes = []
            for text in batch.column(1):
                parts = chunks(text.as_py())
                sizes.append((sum(map(len, parts)), sum(len(good(p)) for p in parts), sum(len(bad(p)) for p in parts)))
            columns = [pa.array(c, pa.int64()) for c in np.array(sizes, np.int64).reshape(-1, 3).T]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", "n_bytes", "good_bytes", "bad_bytes"])

        return step

    schema = StructType([rows.schema["row"], *StructType.fromDDL(SIZES)])
    return map_batches(rows.select("row", text_or_empty().cast("binary").alias("text")), schema, start)


def _inputs() -> list[Column]:
    """The size difference, normalised by the compressed and by the plain size, and the compressed share: itself,
    squared, its logarithm, and with the text's length. Zeros for empty texts, which so share one score."""
    some = F.col("n_bytes") > 0
    both = F.col("good_bytes") + F.col("bad_bytes")
    gain = F.col("bad_bytes") - F.col("good_bytes")
    share = both / (2 * F.col("n_bytes"))
    inputs = (gain / both, gain / F.col("n_bytes"), share, share * share, F.log(share), F.log("n_bytes"), share * F.log("n_bytes"))
    return [F.when(some, x).otherwise(0.0) for x in inputs]


def fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, a small ridge on standardised inputs; weights for raw inputs, intercept last."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w, ridge = np.zeros(z.shape[1]), np.diag([penalty] * x.shape[1] + [1e-6]) * len(x)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    raw = w[:-1] / spread
    return np.append(raw, w[-1] - raw @ mean)


def without_shared_lines(rows: list[tuple[int, list[bytes]]]) -> list[list[bytes]]:
    """The chunks of bad and of good rows, less the lines that several rows share: those tell no class."""
    seen = Counter(line for _, parts in rows for line in {x for p in parts for x in p.split(b"\n")})
    own = [(good, b"\n".join(x for x in p.split(b"\n") if seen[x] == 1)) for good, parts in rows for p in parts]
    return [sorted(p for good, p in own if good == g and p) for g in (0, 1)]


def learn(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    Rows are taken in the order of a hash of their id, apart for each class. Without rows of both classes
    every score is the share of good rows, or one half without any.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    order = F.xxhash64(F.lit(6), "doc_id")
    taken = [known.filter(F.col("good") == g).orderBy(order, "doc_id").limit(sample.rows) for g in (0, 1)]
    picked = F.broadcast(taken[0].unionByName(taken[1]).withColumn("half", F.pmod(order, F.lit(2)).cast("int")))  # two classes of at most ``rows`` ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).join(picked, "doc_id")

    def spaced(batch):
        keys, rows_ = [batch.column(k).to_pylist() for k in range(2)], []
        for text in batch.column(2).to_pylist():
            parts = chunks(text or b"")
            some = sorted({round(k * (len(parts) - 1) / max(1, sample.chunks - 1)) for k in range(sample.chunks)}) if parts else []
            rows_.append([parts[k] for k in some])
        return pa.RecordBatch.from_arrays([*(pa.array(k, pa.int32()) for k in keys), pa.array(rows_, pa.list_(pa.binary()))], names=["good", "half", "parts"])

    cut = map_batches(texts.select("good", "half", F.col("text").cast("binary").alias("text")), "good int, half int, parts array<binary>", lambda: spaced).collect()

    def primed(halves: tuple[int, ...]) -> Model:
        bad, good = without_shared_lines([(r["good"], [bytes(p) for p in r["parts"]]) for r in cut if r["half"] in halves])
        return Model(good=dictionary(good), bad=dictionary(bad))

    # The curve is fitted on sizes that dictionaries of the other half gave; the final ones use both halves.
    model, seen = primed((0, 1)), []
    for half in (0, 1):
        rest = texts.filter(F.col("half") == half).select(F.struct("good").alias("row"), "text")
        seen += with_sizes(rest, primed((1 - half,))).select(F.col("row.good").cast("double").alias("y"), *[c.alias(f"x{k}") for k, c in enumerate(_inputs())]).collect()
    y = np.array([r["y"] for r in sorted(seen)])
    if not y.size or y.min() == y.max():
        share = y.mean() if y.size else 0.5
        return Model(model.good, model.bad, (*[0.0] * len(_inputs()), float(np.log((share + 1e-3) / (1 - share + 1e-3)))))
    x = np.array([r[1:] for r in sorted(seen)])
    return Model(model.good, model.bad, tuple(map(float, fit_curve(x, y))))


def _curve(model: Model) -> Column:
    *w, base = model.weights
    line = sum((F.lit(k) * c for k, c in zip(w, _inputs(), strict=True)), F.lit(base))
    return 1 / (1 + F.exp(-line))


def with_score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``) and ``score``: 0 to 1, higher where good is likelier.

    Rows are scored apart, so repeated rows and null ids stay; a null text counts as empty, and all empty texts
    share one score.
    """
    rows = packed(docs).withColumn("text", F.col(f"row.`{text_col}`"))
    return with_sizes(rows, model).select("row", _curve(model).alias("score"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; other columns are not read. A null id is not held out."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = with_sizes(rows.select(F.struct("doc_id").alias("row"), "text"), model)
    out = out.select("row", _curve(model).alias("score"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "score").select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
