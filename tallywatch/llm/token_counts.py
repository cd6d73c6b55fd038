"""Token counts that follow edits: a segment tree of pre-tokens for every document.

Pre-tokens are encoded apart, so a text's count is the sum of theirs. Their lengths and counts are kept in
blocks, with the blocks' sums in a binary tree. An edit finds its place from the sums, re-reads pre-tokens
from a little before it until a boundary meets one of before, encodes only those, and updates the sums above
the blocks it touched. A pre-token ends where the two characters after it decide, so one that ends two or
more characters before an edit stands; and the pre-tokens after a boundary depend on nothing before it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.byte_ids import ByteIds
from tallywatch.llm.tables import map_batches, text_or_empty

BLOCK = 64  # pre-tokens of a new block
CONTEXT = 2  # characters after a pre-token that can decide where it ends


class Counter:
    """Counts of single pre-tokens, of one worker."""

    def __init__(self, path: str, limit: int = 250_000):
        self.ids = ByteIds(path, limit)
        self.split = self.ids.find
        self.scan = self.ids.scan

    def counts(self, pretokens: list[str]) -> np.ndarray:
        out = np.fromiter(map(len, map(self.ids.pretoken.__getitem__, pretokens)), np.int64, len(pretokens)) // 2
        self.ids.pretoken.trim()
        return out


class Tree:
    """Lengths and counts of a text's pre-tokens, in blocks; sums of both over a binary tree of the blocks."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        cuts = range(0, max(1, len(lengths)), BLOCK)
        self.blocks = [np.column_stack([lengths[k : k + BLOCK], counts[k : k + BLOCK]]) for k in cuts]
        self._sum_all()
        self.encoded = 0

    def _sum_all(self) -> None:
        self.width = 1 << (len(self.blocks) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for k, block in enumerate(self.blocks):
            self.sums[self.width + k] = block.sum(axis=0)
        level = self.width
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level //= 2

    @classmethod
    def of(cls, text: str, counter: Counter) -> Tree:
        pretokens = counter.split(text)
        return cls(np.fromiter(map(len, pretokens), np.int64, len(pretokens)), counter.counts(pretokens))

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    def _update(self, block: int) -> None:
        k = self.width + block
        self.sums[k] = self.blocks[block].sum(axis=0)
        while k > 1:
            k //= 2
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]

    def find(self, at: int) -> tuple[int, int, int]:
        """The last pre-token that starts at or before ``at``: its block, its number in the block, its start."""
        k, start = 1, 0
        at = min(at, max(0, int(self.sums[1, 0]) - 1))
        while k < self.width:
            k *= 2
            if at - start >= self.sums[k, 0]:
                start += int(self.sums[k, 0])
                k += 1
        block = k - self.width
        ends = np.cumsum(self.blocks[block][:, 0]) if len(self.blocks[block]) else np.zeros(0, np.int64)
        place = int(np.searchsorted(ends, at - start, "right"))
        return block, place, start + (int(ends[place - 1]) if place else 0)

    def replace(self, text: str, at: int, deleted: int, inserted: str, counter: Counter) -> str:
        """Edit ``text``: ``inserted`` instead of ``deleted`` characters from ``at``. Returns the new text."""
        at = min(max(0, at), len(text))
        deleted = min(max(0, deleted), len(text) - at)
        new = text[:at] + inserted + text[at + deleted :]
        shift = len(inserted) - deleted
        if not len(text):
            fresh = Tree.of(new, counter)
            self.blocks, self.encoded = fresh.blocks, self.encoded + sum(map(len, fresh.blocks))
            self._sum_all()
            return new
        block, place, start = self.find(max(0, at - CONTEXT))
        old = self._leaves(block, place, start)
        old_end, gone = start, 0
        pretokens, end = [], start
        for m in counter.scan(new, start):
            pretokens.append(m.group())
            end = m.end()
            while old_end + shift < end or old_end < at + deleted:
                step = next(old, None)
                if step is None:
                    break
                old_end, gone = step, gone + 1
            if old_end + shift == end and old_end >= at + deleted:
                break
        else:
            gone += sum(1 for _ in old)
        fresh = np.column_stack([np.fromiter(map(len, pretokens), np.int64, len(pretokens)), counter.counts(pretokens)])
        self.encoded += len(pretokens)
        self._splice(block, place, gone, fresh)
        return new

    def _leaves(self, block: int, place: int, end: int):
        """Ends of the pre-tokens from one on."""
        while block < len(self.blocks):
            for length in self.blocks[block][place:, 0].tolist():
                end += length
                yield end
            block, place = block + 1, 0

    def _splice(self, block: int, place: int, gone: int, fresh: np.ndarray) -> None:
        first = self.blocks[block]
        take = min(gone, len(first) - place)
        self.blocks[block] = np.concatenate([first[:place], fresh, first[place + take :]])
        self._update(block)
        gone, k = gone - take, block + 1
        while gone and k < len(self.blocks):
            take = min(gone, len(self.blocks[k]))
            self.blocks[k] = self.blocks[k][take:]
            self._update(k)
            gone, k = gone - take, k + 1
        if len(self.blocks[block]) > 16 * BLOCK:
            whole = np.concatenate(self.blocks)
            self.blocks = [whole[k : k + BLOCK] for k in range(0, len(whole), BLOCK)]
            self._sum_all()

    def to_bytes(self) -> bytes:
        """Numbers of blocks and of their pre-tokens, then lengths and counts, as little-endian 32-bit integers."""
        sizes = np.array([len(self.blocks), *map(len, self.blocks)], "<u4")
        return sizes.tobytes() + np.concatenate(self.blocks).astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, body: bytes) -> Tree:
        data = np.frombuffer(body, "<u4").astype(np.int64)
        sizes, leaves = data[1 : 1 + data[0]], data[1 + data[0] :].reshape(-1, 2)
        tree = cls.__new__(cls)
        tree.blocks = np.split(leaves, np.cumsum(sizes)[:-1])
        tree.encoded = 0
        tree._sum_all()
        return tree


@lru_cache(maxsize=2)
def _counter(path: str, limit: int) -> Counter:
    return Counter(path, limit)


WHOLE_TEXTS, EDITED = 250_000, 50_000  # pre-tokens a worker remembers of whole texts, and of edited regions


EDITS = "array<struct<at: long, deleted: long, inserted: string>>"


def count(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str | None = None) -> DataFrame:
    """``doc_id, text, edits, n_tokens, tree``: the count of every whole text, and its tree.

    A null text is empty and has no tokens. Strings of special tokens count as ordinary text. Rows are
    independent, so repeated rows and null ids stay; columns other than those named are not read.
    """

    def start():
        counter = _counter(tokenizer, WHOLE_TEXTS)

        def step(batch):
            trees = [Tree.of(t.as_py(), counter) for t in batch.column(1)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([t.total for t in trees], pa.int64()), pa.array([t.to_bytes() for t in trees], pa.binary())],
                names=["doc_id", "text", "edits", "n_tokens", "tree"],
            )

        return step

    edits = F.coalesce(F.col(edits_col).cast(EDITS), F.array().cast(EDITS)) if edits_col else F.array().cast(EDITS)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), edits.alias("edits"))
    return map_batches(rows, f"doc_id long, text string, edits {EDITS}, n_tokens long, tree binary", start)


def recount(counted: DataFrame, tokenizer: str) -> DataFrame:
    """Apply each row's edits, in order, to its text and tree: ``text`` and ``tree`` are the new ones, ``n_tokens`` the
    old count; adds ``n_edited`` (the new count) and ``n_encoded`` (pre-tokens encoded for it).

    Positions count characters of the text as the edits before left it, and are held inside it; a null
    position is 0, a null length 0, a null insertion empty, and a null edit changes nothing.
    """

    def start():
        counter = _counter(tokenizer, EDITED)

        def step(batch):
            texts, trees = [], []
            for text, edits, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(4), strict=True):
                tree = Tree.from_bytes(body.as_py())
                for e in edits:
                    if e is not None:
                        text = tree.replace(text, e["at"] or 0, e["deleted"] or 0, e["inserted"] or "", counter)
                texts.append(text)
                trees.append(tree)
            columns = [batch.column(0), pa.array(texts, pa.string()), batch.column(3), pa.array([t.total for t in trees], pa.int64())]
            columns += [pa.array([t.encoded for t in trees], pa.int64()), pa.array([t.to_bytes() for t in trees], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_tokens", "n_edited", "n_encoded", "tree"])

        return step

    return map_batches(counted.select("doc_id", "text", "edits", "n_tokens", "tree"), "doc_id long, text string, n_tokens long, n_edited long, n_encoded long, tree binary", start)


def drawn_edits(text: str = "text", id_col: str = "doc_id", n: int = 4) -> F.Column:
    """``n`` edits of a row, drawn by a hash of its id: each deletes up to 40 characters somewhere and inserts up to 40 from elsewhere in the text."""

    def draw(k: int, what: str, below: F.Column) -> F.Column:
        return F.pmod(F.xxhash64(F.lit(what), F.lit(k), F.col(id_col)), below)

    size = F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    one = [
        F.struct(
            draw(k, "at", size + 1).alias("at"),
            draw(k, "deleted", F.lit(41).cast("long")).alias("deleted"),
            F.substring(F.coalesce(F.col(text), F.lit("")), (draw(k, "from", size + 1) + 1).cast("int"), draw(k, "inserted", F.lit(41).cast("long")).cast("int")).alias("inserted"),
        )
        for k in range(n)
    ]
    return F.array(*one)
