"""Byte-level BPE ids of whole texts, one pre-token run at a time.

A space that follows a non-space always starts a new pre-token, so a text is cut at its spaces and each
piece is encoded once per worker; so does a sign between a letter and white space, and is cut off, lest every word be kept
once for each sign after it. The tokenizers library encodes what the worker has not seen lately, and
whole texts wherever runs of white space make such a cut unsafe.
"""

from __future__ import annotations

from array import array

import numpy as np
import regex

from tallywatch.llm.tables import kept_by_worker

# The byte-level pre-token pattern, as every file of this kind uses it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

RECENT = 400_000  # pieces a worker keeps in each of two generations
COUNTED = 200_000  # the same where only numbers of ids are asked for
GLUED = "\0"  # opens a piece that follows no space
#: Signs that are cut off where a letter is before them; what they become; whether a letter must follow too.
SIGNS = ((", ", f" {GLUED}, ", False), (". ", f" {GLUED}. ", False), (".\n", f" {GLUED}.\n {GLUED}", True))


def byte_characters() -> str:
    """The printable stand-in of each byte: printable Latin-1 stands for itself, the rest follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, spare = {}, 256
    for b in range(256):
        if b in own:
            table[b] = chr(b)
        else:
            table[b] = chr(spare)
            spare += 1
    return "".join(table[b] for b in range(256))


class Recent(dict):
    """A bounded memo: two generations, the older one dropped when the newer is full."""

    def __init__(self, compute, limit: int = RECENT):
        super().__init__()
        self.compute, self.limit, self.older = compute, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value

    def trim(self) -> None:
        """Between texts: start a new generation if this one is full."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class Unsafe(Exception):
    """The text cannot be cut at this space."""


def _signs_apart(text: str) -> str:
    """The text with its ``SIGNS`` as pieces of their own; a kind that stands anywhere else in it stays as it is."""
    for sign, apart, letters in SIGNS:
        parts = text.split(sign)
        if all(map(str.isalpha, [p[-1:] for p in parts[:-1]])) and not (letters and not all(map(str.isalpha, [p[:1] for p in parts[1:]]))):
            text = apart.join(parts)
    return text


class ByteIds:
    """Encoder of one worker. ``path``: a tokenizers file with byte-level pre-tokens and at most 65,536 ids."""

    def __init__(self, path: str, limit: int = RECENT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pattern = regex.compile(PATTERN)
        self.find = pattern.findall
        self.scan = lambda text, start: pattern.finditer(text, start)
        self.stand_in = byte_characters()
        self.space = self.stand_in[32]
        self.pretoken = Recent(self._pretoken, limit)
        self.after_space = Recent(self._after_space, limit)

    @staticmethod
    def _of(tokens: list) -> bytes:
        return array("H", [t.id for t in tokens]).tobytes()

    @staticmethod
    def _whole(ids: list[int]) -> bytes:
        return np.array(ids, "<u2").tobytes()

    _joined = staticmethod(b"".join)

    def _pretoken(self, pretoken: str) -> bytes:
        mapped = pretoken.encode().decode("latin-1").translate(self.stand_in)
        return self._of(self.model.tokenize(mapped))

    def _after_space(self, piece: str) -> bytes:
        if piece.isalpha():
            if piece.isascii():
                return self._of(self.model.tokenize(self.space + piece))
            return self._pretoken(" " + piece)
        if not piece or piece[0].isspace():
            raise Unsafe
        if piece[0] == GLUED:
            return self._joined(map(self.pretoken.__getitem__, self.find(piece[1:])))
        word = piece[:-1]
        if word.isalpha() and not piece[-1].isalnum() and not piece[-1].isspace() and piece[-1].isascii():
            return self.after_space[word] + self.pretoken[piece[-1]]
        parts = self.find(" " + piece)
        word = parts[0][1:]
        if word.isalpha() and len(parts) > 1:  # the word may be known without what follows it
            return self.after_space[word] + self._joined(map(self.pretoken.__getitem__, parts[1:]))
        return self._joined(map(self.pretoken.__getitem__, parts))

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian 16-bit integers."""
        if not text:
            return self._joined(())
        try:
            if GLUED in text or any(s in text for s in self.specials):
                raise Unsafe
            first, *rest = _signs_apart(text).split(" ")
            out = self._joined(map(self.pretoken.__getitem__, self.find(first))) + self._joined(map(self.after_space.__getitem__, rest))
        except Unsafe:
            out = self._whole(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self.pretoken.trim()
        self.after_space.trim()
        return out


class ByteCounts(ByteIds):
    """Numbers of ids instead of ids: ``encode`` tells how many a text has, and the memos hold small numbers."""

    _of = _whole = staticmethod(len)
    _joined = staticmethod(sum)


def worker_counts(path: str) -> ByteCounts:
    """The counter of this worker, with what it remembers of earlier tasks of the same operator."""
    return kept_by_worker(("counts", path), lambda: ByteCounts(path, COUNTED))
