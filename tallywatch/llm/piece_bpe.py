"""SentencePiece BPE: encoding by a table of each prefix's last token, and decoding.

Two facts carry the method. The encoding of a prefix ends in exactly one token, and a token may follow
another only if merging the two texts side by side never crosses their border. So one pass over a word
finds, at each position, the one vocabulary match that starts where a compatible prefix ends; the ids are
then read backwards from the last position. Matches come from an automaton over the vocabulary; the pair
test replays both tokens' merges in order and is remembered per pair.

No piece of such a vocabulary holds the space mark after another character, so words are encoded apart and
a worker remembers the words it met lately.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Sequence
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.byte_ids import Recent, Unsafe
from tallywatch.llm.tables import map_batches, text_or_empty

SPACE = "▁"
RECENT = 250_000  # words a worker keeps in each of two generations
PAIRS = 400_000  # pairs whose compatibility it keeps


class Pieces:
    """Pieces and scores of a model file with byte fallback, and its special ids."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.end_id, self.size = model.eos_id(), model.vocab_size()
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.surface: list[str | None] = [""] * self.size  # None: a byte
        self.byte_of: dict[int, int] = {}
        self.marked: set[int] = set()  # pieces that begin with the space mark
        for k in range(self.size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte_id[int(piece[1:-1], 16)] = k
                self.byte_of[k] = int(piece[1:-1], 16)
                self.surface[k] = None
            elif model.is_unknown(k):
                self.surface[k] = " ⁇ "
            elif not model.is_control(k):
                if model.is_unused(k) or SPACE in piece.lstrip(SPACE):
                    raise ValueError("this vocabulary cannot be encoded word by word")
                self.score[piece], self.ids[piece] = model.get_score(k), k
                self.surface[k] = piece.replace(SPACE, " ")
                if piece[0] == SPACE:
                    self.marked.add(k)
        if len(self.byte_id) != 256:
            raise ValueError("a model with byte fallback is needed")

    def merges(self, text: str) -> list[tuple[float, str, str]]:
        """The merges of ``text`` alone, best score and then leftmost first: (score, first symbol, last symbol) after each."""
        symbols, out = list(text), []
        while len(symbols) > 1:
            best = max(((self.score.get(a + b, -np.inf), -k) for k, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))))
            if best[0] == -np.inf:
                break
            k = -best[1]
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            out.append((best[0], symbols[0], symbols[-1]))
        return out if len(symbols) == 1 else [*out, (-np.inf, "", "")]

    def decode(self, ids: Sequence[int]) -> str:
        """Text of ``ids``: pieces joined, byte runs read as UTF-8, the leading space mark dropped."""
        surface = self.surface
        try:
            out = "".join([surface[k] for k in ids])
        except TypeError:
            out = self._decode_bytes(ids)
        first = next((k for k in ids if surface[k] != ""), None)
        return out[1:] if first in self.marked else out

    def _decode_bytes(self, ids: Sequence[int]) -> str:
        out, run, surface, byte_of = [], bytearray(), self.surface, self.byte_of
        for k in ids:
            if surface[k] is None:
                run.append(byte_of[k])
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            out.append(surface[k])
        out.append(_utf8(run))
        return "".join(out)


class PrefixTable:
    """Encoder of single words."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.text = {k: piece for piece, k in pieces.ids.items()}
        self.history: dict[str, list[tuple[float, str, str]]] = {}
        self.fits = PairMemo(self)
        self.characters = {piece for piece in pieces.ids if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, k in pieces.ids.items():
            self.history[piece] = done = pieces.merges(piece)
            if not done or done[-1][0] > -np.inf:  # else no merging ever yields this piece
                self.automaton.add_word(piece, (k, len(piece) - 1))
        self.automaton.make_automaton()

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merges of ``left`` and ``right``, side by side, all end before any merge across their border."""
        a, b, score = self.history[left], self.history[right], self.pieces.score
        i = j = 0
        edge, start = left[-1], right[0]
        while True:
            x = a[i][0] if i < len(a) else -np.inf
            y = b[j][0] if j < len(b) else -np.inf
            across = score.get(edge + start, -np.inf)
            if across > x and across >= y and across > -np.inf:
                return False
            if x == y == -np.inf:
                return True
            if x >= y:
                edge, i = a[i][2], i + 1
            else:
                start, j = b[j][1], j + 1

    def encode(self, word: str) -> list[int]:
        """Ids of ``word``; characters outside the vocabulary become their bytes."""
        if not self.characters.issuperset(word):
            return [k for part in self._split(word) for k in (self._known(part) if part[0] in self.characters else map(self.pieces.byte_id.__getitem__, part.encode()))]
        return self._known(word)

    def _split(self, word: str) -> list[str]:
        """Runs of known and of unknown characters: no piece, so no merge, crosses from one into the other."""
        return ["".join(run) for _, run in groupby(word, self.characters.__contains__)]

    def _known(self, word: str) -> list[int]:
        last = [-1] * (len(word) + 1)  # the last token of each prefix; at 0 there is none
        sizes, fits = [0] * (len(word) + 1), self.fits
        for end, (k, more) in self.automaton.iter(word):
            start = end - more
            if start and not (last[start] >= 0 and fits[last[start] << 20 | k]):
                continue
            last[end + 1], sizes[end + 1] = k, more + 1
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= sizes[at]
        out.reverse()
        return out


class PairMemo(dict):
    """Compatibility of pairs, ``left id << 20 | right id``."""

    def __init__(self, table: PrefixTable):
        super().__init__()
        self.table = table

    def __missing__(self, pair: int) -> bool:
        text = self.table.text
        self[pair] = out = self.table.compatible(text[pair >> 20], text[pair & 0xFFFFF])
        return out


class PieceEncoder:
    """Encoder of one worker."""

    def __init__(self, path: str, limit: int = RECENT):
        self.pieces = Pieces(path)
        self.table = PrefixTable(self.pieces)
        self.words = Recent(self._word, limit)
        self.parts = Recent(self._part, limit // 4)
        self.pairs = {a + b for piece in self.pieces.score for a, b in zip(piece, piece[1:], strict=False)}
        alone = [c for c in map(chr, range(128)) if not c.isalnum() and c != " "]
        # Cut around an ASCII mark wherever no piece holds both neighbours; only pieces decide which cuts are safe.
        self.marks = re.compile("([" + re.escape("".join(alone)) + "])")
        self.end = array("i", [self.pieces.end_id]).tobytes()

    def _part(self, part: str) -> bytes:
        return array("i", self.table.encode(part)).tobytes()

    def _word(self, word: str) -> bytes:
        if not word or SPACE in word:
            raise Unsafe
        whole = SPACE + word
        if word.isalpha():
            return self._part(whole)
        cut: list[str] = []
        for piece in filter(None, self.marks.split(whole)):
            if cut and cut[-1][-1] + piece[0] in self.pairs:
                cut[-1] += piece
            else:
                cut.append(piece)
        if len(cut) > 1 and cut[0][1:].isalpha():
            return self.words[cut[0][1:]] + b"".join(map(self.parts.__getitem__, cut[1:]))
        return b"".join(map(self.parts.__getitem__, cut))

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` with the end id, as 32-bit integers."""
        if not text:
            return self.end
        try:
            out = b"".join(map(self.words.__getitem__, text.split(" ")))
        except Unsafe:  # runs of spaces, or spaces at an end: words carry their runs
            marked = SPACE + text.replace(" ", SPACE)
            out = b"".join(map(self.parts.__getitem__, re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", marked)))
        self.words.trim()
        self.parts.trim()
        if len(self.table.fits) > PAIRS:
            self.table.fits.clear()
        return out + self.end


def _utf8(run: bytearray) -> str:
    """The characters of a byte run; each byte that belongs to none becomes U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError as e:
        return run[: e.start].decode() + "�" + _utf8(run[e.start + 1 :])


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids array<int>`` of every whole text, end id included and no begin id.

    A null or empty text has the end id only. Rows are independent: repeated rows and ids stay, a null id
    stays null, other columns are not read, and an empty table gives an empty one.
    """

    def start():
        one = encoder(model)

        def step(batch):
            bodies = [one.encode(x.as_py()) for x in batch.column(1)]
            ends = np.zeros(len(bodies) + 1, np.int32)
            np.cumsum([len(b) // 4 for b in bodies], out=ends[1:])
            ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(bodies))])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), ids)], names=["doc_id", "ids"])

        return step

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_batches(rows, "doc_id long, ids array<int>", start)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Adds ``decoded string`` to ``doc_id, ids``."""

    def start():
        one = pieces(model)

        def step(batch):
            ids = batch.column(1)
            flat, ends = np.asarray(ids.values), np.asarray(ids.offsets)
            texts = [one.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)]
            return pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

        return step

    return map_batches(encoded.select("doc_id", "ids"), "doc_id long, ids array<int>, decoded string", start)
