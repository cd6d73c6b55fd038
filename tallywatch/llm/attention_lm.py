"""Scores of whole texts by a causal self-attention model on subword ids, beside a smoothed word-count base.

Texts are lower-cased (A-Z) and cut into words; a word's subword ids come from the sentencepiece library, once for each word of
a block of texts. What is learned from all training texts: how often every word occurs (for the base), how often
every id and every pair of neighbouring slots does (for the tables the model starts from). The attention weights are trained by
local Adam steps: from the same start, every task trains once on every window of its training texts, and the weights
are averaged by the number of windows. All of this grows with the input; nothing is left out or drawn.

Scoring lays windows of ``WIDTH`` positions over each text, every ``STEP`` positions; each position is scored once, with at
least ``BEFORE`` positions (or the text's beginning) before it, in batches of masked attention.

Work moves in blocks of texts (an Arrow batch, at most 12 MB or one text): one row holds a block's distinct words as 96-bit names and its texts as places in that list. Words
meet across blocks in ranges of their names, so the shuffle carries one number for each distinct word of a block.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import attention_net as net
from tallywatch.llm.tables import partitions_for, stored

IDS = 32_000  # the tokenizer's ids
END_ID, NO_ID = 2, 0
FIRST_BATCH, BATCH = 32, 512  # windows of the first step and of the later ones; one more with each step between
RATE = 3e-3
WINDOWS = 512  # windows scored at a time
REST = net.SLOTS - 1  # the slot of all ids without one of their own


@contextmanager
def small_batches(spark: SparkSession, size: str = "12m"):
    """While the tables here are computed, a worker gets at most this much at a time: a row is a block of texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


# --- blocks -----------------------------------------------------------------------------------


class Pieces:
    """Subword ids of words. ``path``: a sentencepiece model whose ids lie below 32,000."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        if self.library.get_piece_size() > IDS:
            raise ValueError("too many ids")

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has."""
        ids, counts = array("H"), np.empty(len(words), np.int64)
        for k in range(0, len(words), 4096):
            part = [own or [NO_ID] for own in self.library.encode(words[k : k + 4096], num_threads=1)]
            ids.extend(chain.from_iterable(part))
            counts[k : k + len(part)] = [len(own) for own in part]
        return np.array(ids, "<u2"), counts


_pieces: dict[str, Pieces] = {}


def worker_pieces(path: str) -> Pieces:
    if path not in _pieces:
        _pieces.clear()
        _pieces[path] = Pieces(path)
    return _pieces[path]


BLOCKS = (
    "block long, doc_ids array<long>, held array<boolean>, lengths array<int>, "
    "words binary, names binary, pieces binary, piece_counts binary"
)


NAME = np.dtype([("high", "<u8"), ("low", "<u4")])  # 96 bits of a word's hash


def _block(batch: pa.RecordBatch, name: int, pieces: Pieces, schema: pa.Schema) -> pa.RecordBatch:
    """One row of the texts of a batch: Arrow lower-cases A-Z, cuts at the six white-space bytes and finds the distinct words."""
    import xxhash

    texts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column("text"), "")))
    offsets, words = texts.offsets.to_numpy(), texts.flatten()
    there = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)  # the cut leaves empty ends
    lengths = np.diff(np.concatenate([[0], np.cumsum(there)])[offsets - offsets[0]])
    coded = words.filter(pa.array(there)).dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False)
    digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in distinct]), ">u8").reshape(-1, 2)
    order = np.lexsort((digests[:, 1] >> np.uint64(32), digests[:, 0]))
    rank = np.empty(order.size, "<u4")
    rank[order] = np.arange(order.size)
    names = np.empty(order.size, NAME)
    names["high"], names["low"] = digests[order, 0], digests[order, 1] >> np.uint64(32)
    ids, counts = pieces.of(distinct[order].tolist())
    row = {
        "block": name,
        "doc_ids": batch.column("doc_id").to_pylist(),
        "held": batch.column("held").to_pylist(),
        "lengths": lengths,
        "words": rank[coded.indices.to_numpy()].tobytes(),
        "names": names.tobytes(),
        "pieces": ids.tobytes(),
        "piece_counts": counts.astype("<u4").tobytes(),
    }
    return pa.RecordBatch.from_pylist([row], schema=schema)


def _blocks(batches, path: str, schema: pa.Schema):
    pieces, first = worker_pieces(path), TaskContext.get().partitionId() << 32
    for n, batch in enumerate(batches):
        if batch.num_rows:
            yield _block(batch, first + n, pieces, schema)


def blocks(docs: DataFrame, path: str, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All texts in blocks, written once. Texts for which ``held`` (a column of the row) is true are not learned from."""
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), *[(c, pa.binary()) for c in ("words", "names", "pieces", "piece_counts")]])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(lambda batches: _blocks(batches, path, schema), BLOCKS), "lm-blocks")


class Texts:
    """A block's row as arrays."""

    def __init__(self, row: dict):
        self.name, self.doc_ids = row["block"], row["doc_ids"]
        self.held = np.array(row["held"], bool)
        self.lengths = np.array(row["lengths"], np.int64)
        self.words = np.frombuffer(row["words"], "<u4")
        if row.get("pieces") is not None:
            self.pieces = np.frombuffer(row["pieces"], "<u2").astype(np.int32)
            self.counts = np.frombuffer(row["piece_counts"], "<u4").astype(np.int64)

    def learned_words(self, distinct: int) -> np.ndarray:
        """How often each distinct word occurs in texts to learn from."""
        return np.bincount(self.words[np.repeat(~self.held, self.lengths)], minlength=distinct)

    def select(self, texts: np.ndarray) -> np.ndarray:
        """Words of some texts, end to end."""
        return self.words[np.repeat(texts, self.lengths)]

    def stream(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chosen texts end to end, each after -1 and before the end id; positions to score in each."""
        words, lengths = self.select(texts), self.lengths[texts]
        counts = self.counts[words]
        begin = np.cumsum(self.counts) - self.counts
        sums = np.concatenate([[0], np.cumsum(counts)])
        edges = np.concatenate([[0], np.cumsum(lengths)])
        each = sums[edges[1:]] - sums[edges[:-1]]  # ids of each text
        ids = np.empty(int(sums[-1]) + 2 * lengths.size, np.int32)
        ends = np.cumsum(each + 2)
        inner = np.ones(ids.size, bool)
        inner[ends - 1] = False
        inner[ends - each - 2] = False
        at = np.arange(int(sums[-1])) + np.repeat(begin[words] - sums[:-1], counts)
        ids[inner] = self.pieces[at]
        ids[ends - 1] = END_ID
        ids[ends - each - 2] = -1
        return ids, each + 1


def _texts(batches, columns: list[str]) -> Iterator[Texts]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Texts({c: batch.column(c)[k].as_py() for c in columns})


# --- words of all training texts ---------------------------------------------------------------


COUNTS = "part int, block long, totals binary, distinct long, learned long"


def _ranges(batches, parts: int):
    """Of each block, the names in each range and their counts in texts to learn from."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in ("block", "held", "lengths", "words", "doc_ids")}
            names = np.frombuffer(batch.column("names")[k].as_py(), NAME)
            counts = Texts(row).learned_words(len(names)).astype("<u4")
            part = ((names["high"] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cuts))
            out = [(int(p), row["block"], names[cuts[p] : cuts[p + 1]].tobytes(), counts[cuts[p] : cuts[p + 1]].tobytes()) for p in some]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["part", "block", "names", "counts"])


def _totals(batches):
    """Counts of every name over all blocks, handed back to each block; with each range its distinct names and their sum."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("totals", pa.binary()), ("distinct", pa.int64()), ("learned", pa.int64())])

    def close(part, held):
        names = np.concatenate([np.frombuffer(n, NAME) for _, n, _ in held])
        counts = np.concatenate([np.frombuffer(c, "<u4") for *_, c in held])
        order = np.lexsort((names["low"], names["high"]))
        ordered = names[order]
        new = np.ones(order.size, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        sums = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(new))
        totals = np.empty(order.size, np.int64)
        totals[order] = sums[np.cumsum(new) - 1]
        cuts = np.cumsum([0, *[len(c) // 4 for *_, c in held]])
        rows = [{"part": part, "block": b, "totals": totals[cuts[k] : cuts[k + 1]].tobytes()} for k, (b, _, _) in enumerate(held)]
        rows.append({"part": part, "block": None, "distinct": int((sums > 0).sum()), "learned": int(sums.sum())})
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    part, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part and held:
                yield close(part, held)
                held = []
            part = row["part"]
            held.append((row["block"], row["names"], row["counts"]))
    if held:
        yield close(part, held)


def word_totals(encoded: DataFrame) -> DataFrame:
    """``part, block, totals``: for each block, the training count of each of its words, in ranges of their names; rows without block sum a range up.

    A task holds one range. There are as many as the session's shuffle partitions, so a range follows the input as those do.
    """
    parts = partitions_for(encoded.sparkSession)
    sent = encoded.select("block", "doc_ids", "held", "lengths", "words", "names").mapInArrow(lambda batches: _ranges(batches, parts), "part int, block long, names binary, counts binary")
    met = sent.repartitionByRange(parts, "part").sortWithinPartitions("part", "block")
    return stored(met.mapInArrow(_totals, COUNTS), "lm-totals")


# --- what the model starts from ------------------------------------------------------------------


@dataclass
class Model:
    """``slot``: of each id; ``rest``: log probability of each id within slot ``REST``; ``pairs``: counts of neighbouring slots."""

    slot: np.ndarray
    rest: np.ndarray
    pairs: np.ndarray
    weights: dict[str, np.ndarray]

    def net(self) -> net.Net:
        return net.Net({k: v.copy() for k, v in self.weights.items()}, net.counted_table(self.pairs))


def _id_counts(batches):
    counts = np.zeros(IDS, np.int64)
    for texts in _texts(batches, ["block", "doc_ids", "held", "lengths", "words", "pieces", "piece_counts"]):
        counts += np.bincount(texts.pieces, np.repeat(texts.learned_words(texts.counts.size), texts.counts), IDS).astype(np.int64)
        counts[END_ID] += int((~texts.held).sum())
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], names=["id", "n"])


def id_counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all training texts; one row per id reaches the driver."""
    out = np.zeros(IDS, np.int64)
    for row in encoded.mapInArrow(_id_counts, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row["id"]] = row["n"]
    return out


def slots_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A slot for each of the most frequent ids (ties by id), one for the others; log probability of each id within that."""
    order = np.argsort(-counts, kind="stable")
    slot = np.full(IDS, REST, np.int32)
    slot[order[:REST]] = np.arange(REST)
    rest = np.where(slot == REST, counts + 0.01, 0.0)
    with np.errstate(divide="ignore"):
        return slot, np.where(slot == REST, np.log(rest / rest.sum()), 0.0)


def _slot_stream(texts: Texts, which: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, lengths = texts.stream(which)
    return np.where(ids < 0, net.OPENS, slot[ids]), ids, lengths


def _pair_counts(batches, slot: np.ndarray):
    """Counts of neighbouring slots in a task's training texts, one row per first slot."""
    width = net.SLOTS + 1
    counts = np.zeros(width * width, np.int64)
    for texts in _texts(batches, ["block", "doc_ids", "held", "lengths", "words", "pieces", "piece_counts"]):
        if not texts.held.all():
            stream, _, _ = _slot_stream(texts, ~texts.held, slot)
            counts += np.bincount(stream[:-1] * np.int32(width) + stream[1:], minlength=counts.size)
    table = counts.reshape(width, width)[:, : net.SLOTS]  # what opens a text is not predicted
    some = np.flatnonzero(table.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([table[k].astype("<i8").tobytes() for k in some], pa.binary())], names=["key", "numbers"])


def _added(batches, kind: str):
    """Sum of the number lists of each key; keys come sorted."""
    key, total = None, None
    schema = pa.schema([("key", pa.int32()), ("numbers", pa.binary())])
    for batch in batches:
        for k, numbers in zip(batch.column("key").to_pylist(), batch.column("numbers"), strict=True):
            values = np.frombuffer(numbers.as_py(), kind)
            if k != key:
                if total is not None:
                    yield pa.RecordBatch.from_pylist([{"key": key, "numbers": total.tobytes()}], schema=schema)
                key, total = k, values.copy()
            else:
                total += values
    if total is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "numbers": total.tobytes()}], schema=schema)


def sums(rows: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """Sum of ``numbers`` for each ``key``; one list per key reaches the driver."""
    met = rows.repartition(partitions_for(rows.sparkSession), "key").sortWithinPartitions("key", "numbers")
    return {r["key"]: np.frombuffer(r["numbers"], kind) for r in met.mapInArrow(lambda batches: _added(batches, kind), "key int, numbers binary").collect()}


def pair_counts(encoded: DataFrame, slot: np.ndarray) -> np.ndarray:
    out = np.zeros((net.SLOTS + 1, net.SLOTS), np.int64)
    for key, numbers in sums(encoded.mapInArrow(lambda batches: _pair_counts(batches, slot), "key int, numbers binary"), "<i8").items():
        out[key] = numbers
    return out


# --- training -----------------------------------------------------------------------------------


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in net.SHAPES]).astype(np.float64)


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in net.SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].astype(np.float32).reshape(shape)
        at += size
    return out


PORTION = 1000  # weights in one row


def _trained(batches, model: Model):
    """The weights after a task's steps times its number of windows, in rows of ``PORTION``; key -1 counts the windows."""
    mine = model.net()
    adam, seen_windows = net.Adam(mine.w, RATE), 0
    for texts in _texts(batches, ["block", "doc_ids", "held", "lengths", "words", "pieces", "piece_counts"]):
        if texts.held.all():
            continue
        stream, _, lengths = _slot_stream(texts, ~texts.held, model.slot)
        begin = np.cumsum(lengths + 1) - lengths - 1
        text, first, n = net.windows(lengths)
        mixed = np.random.default_rng(texts.name).permutation(text.size)
        k = 0
        while k < mixed.size:
            w = mixed[k : k + min(FIRST_BATCH + adam.t, BATCH)]
            k += w.size
            seen, want = net.window_slots(stream, begin, text[w], first[w])
            valid = np.arange(net.STEP)[None, :] < n[w][:, None]
            _, g = mine.gradients(seen, first[w] == 0, valid, want)
            adam.step(mine.w, g)
            mine.refresh()
        seen_windows += mixed.size
    if seen_windows:
        flat = _flat(mine.w) * seen_windows
        parts = [flat[k : k + PORTION].tobytes() for k in range(0, flat.size, PORTION)]
        keys, values = [-1, *range(len(parts))], [np.array([seen_windows], "<f8").tobytes(), *parts]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(values, pa.binary())], names=["key", "numbers"])


def learn(encoded: DataFrame) -> Model:
    """The model of the training texts of ``blocks``. Without any, every slot is equally likely."""
    slot, rest = slots_of(id_counts(encoded))
    model = Model(slot, rest, pair_counts(encoded, slot), net.first_weights())
    got = sums(encoded.mapInArrow(lambda batches: _trained(batches, model), "key int, numbers binary"), "<f8")
    if got:
        n = got.pop(-1)[0]
        model.weights = _shaped(np.concatenate([got[k] for k in sorted(got)]) / n)
    return model


# --- scoring --------------------------------------------------------------------------------------


def log10_probs(texts: Texts, model: Model, ready: net.Net) -> np.ndarray:
    """Log10 probability of each text of a block, its end included."""
    stream, ids, lengths = _slot_stream(texts, np.ones(texts.held.size, bool), model.slot)
    begin = np.cumsum(lengths + 1) - lengths - 1
    out = np.zeros(lengths.size)
    text, first, n = net.windows(lengths)
    for k in range(0, text.size, WINDOWS):
        w = slice(k, k + WINDOWS)
        seen, want = net.window_slots(stream, begin, text[w], first[w])
        valid = np.flatnonzero((np.arange(net.STEP)[None, :] < n[w][:, None]).ravel())
        state = ready.hidden(seen, first[w] == 0)
        logs = ready.log_probs(state.take(valid, axis=0), seen[:, net.BEFORE :].ravel().take(valid), want.ravel().take(valid))
        out += np.bincount(np.repeat(text[w], n[w]), logs, lengths.size)
    rare = np.flatnonzero(stream == REST)
    out += np.bincount(np.searchsorted(begin, rare, side="right") - 1, model.rest[ids[rare]], lengths.size)
    return out / np.log(10)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(batches, model: Model, n: int, v: int, ends: int):
    ready = model.net()
    types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    names = [part.split()[0] for part in SCORES.split(", ")]
    for batch in batches:
        for k in range(batch.num_rows):
            texts = Texts({c: batch.column(c)[k].as_py() for c in ("block", "doc_ids", "held", "lengths", "words", "pieces", "piece_counts")})
            counted = np.frombuffer(b"".join(p["totals"] for p in (batch.column("counted")[k].as_py() or [])), "<i8")
            text = np.repeat(np.arange(texts.lengths.size), texts.lengths)
            size = texts.lengths.size
            base = np.bincount(text, (np.log10(counted + 1.0) - np.log10(n + v + 1.0))[texts.words], size) + (np.log10(ends + 1.0) - np.log10(n + v + 1.0))
            known = np.bincount(text, (counted > 0)[texts.words], size).astype(np.int64) + (ends > 0)
            columns = (texts.doc_ids, texts.held, texts.lengths + 1, known, np.full(size, n), base, log10_probs(texts, model, ready))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def score_blocks(encoded: DataFrame, model: Model, totals: DataFrame) -> DataFrame:
    """One row for each text: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    whole = totals.filter("block IS NULL").agg(F.sum("learned").alias("n"), F.sum("distinct").alias("v")).first()
    ends = encoded.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    n, v = (whole["n"] or 0) + ends, (whole["v"] or 0) + (ends > 0)
    mine = totals.filter("block IS NOT NULL").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "totals"))).alias("counted"))
    met = encoded.drop("names").join(mine, "block", "left")
    return met.mapInArrow(lambda batches: _scored(batches, model, n, v, ends), SCORES)


def score(docs: DataFrame, path: str, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all texts by a model of those for which the column ``held`` is not true.

    The base is the sum over words and the end of log10((c + 1) / (N + V + 1)), with counts c, their sum N and number V from
    training texts; ``n_known`` counts tokens with c > 0. ``score`` is the log10 probability of the text's ids.

    A null text is an empty one, which has its end only. Rows that repeat an id, or have none, are texts of their own; a null
    ``held`` counts as false. Equal texts get scores that differ by rounding at most. An empty table gives an empty
    result. Without training texts N and V are 0. Only the two named columns and those of ``held`` are read.
    """
    with small_batches(docs.sparkSession):
        encoded = blocks(docs, path, held, id_col, text_col)
        return stored(score_blocks(encoded, learn(encoded), word_totals(encoded)), "lm-scores")
