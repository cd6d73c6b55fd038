"""Sorting chosen suffixes of one block of text with a difference cover.

For a period ``v`` the cover holds residues such that any two positions have a common shift below ``v`` that
takes both to covered positions. The suffixes at covered positions are ranked first, by doubling. Any two
others are then compared by at most ``v`` bytes and one pair of those ranks, however long they agree.
"""

from __future__ import annotations

import numpy as np

PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)  # fixed value: a perfect difference set modulo 57


def shifts(period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """``[r, s]``: the smallest shift that takes residues ``r`` and ``s`` into the cover together."""
    covered = np.isin(np.arange(period), cover)
    at = np.arange(period)
    out = np.full((period, period), -1, np.int64)
    for d in range(period - 1, -1, -1):
        both = covered[(at[:, None] + d) % period] & covered[(at[None, :] + d) % period]
        out[both] = d
    if (out < 0).any():
        raise ValueError("not a difference cover")
    return out


SHIFTS = shifts()
TOGETHER = 1 << 17  # suffixes of small buckets that are sorted together


def _heads(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes from each position, as fixed-width strings that sort by unsigned bytes."""
    rows = np.lib.stride_tricks.sliding_window_view(text, length)[at]
    return rows.view(f"S{length}").ravel()


def _dense(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Equal values get equal ranks, counted along ``order``."""
    out = np.empty(order.size, np.int64)
    out[order] = np.cumsum(np.concatenate([[0], values[order[1:]] != values[order[:-1]]]))
    return out


class Block:
    """A block of text whose covered suffixes are ranked."""

    def __init__(self, text: bytes):
        self.size = len(text)
        # Bytes are stored one higher in spirit: the end is padded with zeros, and ranks settle what they tie.
        self.text = np.concatenate([np.frombuffer(text, np.uint8), np.zeros(2 * PERIOD + 256, np.uint8)])
        residues = np.zeros(PERIOD, bool)
        residues[list(COVER)] = True
        at = np.flatnonzero(np.resize(residues, self.size + PERIOD))
        heads = _heads(self.text, at, PERIOD)
        rank = _dense(heads, np.argsort(heads, kind="stable"))
        place = np.full(self.size + 2 * PERIOD, -1, np.int32)  # of each covered position in ``at``
        place[at] = np.arange(at.size)
        length = PERIOD
        while at.size and int(rank.max()) + 1 < at.size:
            later = at + length
            inside = later < self.size + PERIOD
            # Past the end, a position further on is a shorter rest and sorts first.
            follow = np.where(inside, rank[place[np.where(inside, later, 0)]] + self.size + PERIOD, self.size + PERIOD - at)
            follow = np.where(inside, follow, np.maximum(follow, 0))
            pair = rank * (2 * (self.size + PERIOD) + at.size + 1) + follow
            rank = _dense(pair, np.argsort(pair, kind="stable"))
            length *= 2
        self.rank = np.zeros(self.size + 2 * PERIOD, np.int32)
        self.rank[at] = rank

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix ``a`` sorts before suffix ``b``, for pairs that agree on their first ``PERIOD`` bytes."""
        d = SHIFTS[a % PERIOD, b % PERIOD]
        return self.rank[a + d] < self.rank[b + d]

    def sort(self, at: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Indexes of the suffixes ``at``, ordered by bucket and then by suffix."""
        order = np.argsort(_heads(self.text, at, PERIOD), kind="stable")
        order = order[np.argsort(bucket[order], kind="stable")]
        heads, group = _heads(self.text, at[order], PERIOD), bucket[order]
        first = np.concatenate([[True], (heads[1:] != heads[:-1]) | (group[1:] != group[:-1])])
        tie = np.cumsum(first) - 1
        sizes = np.bincount(tie)
        tied = np.flatnonzero(sizes[tie] > 1)
        if tied.size:
            order[tied] = order[tied][self._merge_sort(at[order[tied]], tie[tied])]
        return order

    def _merge_sort(self, at: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """Order of the positions ``at`` inside each run of equal ``tie``: all runs are merged level by level at once.

        A level joins neighbouring stretches of ``width``; an element's new place is its own place in its stretch
        plus the number of elements of the other stretch before it, found by binary search.
        """
        n = at.size
        begin = np.flatnonzero(np.concatenate([[True], tie[1:] != tie[:-1]]))
        sizes = np.diff(np.append(begin, n))
        start, end = np.repeat(begin, sizes), np.repeat(begin + sizes, sizes)
        order, index, width, most = np.arange(n), np.arange(n), 1, int(sizes.max())
        while width < most:
            local = index - start
            stretch = local // width
            other = np.minimum(start + (stretch ^ 1) * width, end)
            lo, hi = other.copy(), np.minimum(other + width, end)
            mine, odd = at[order], (stretch & 1).astype(bool)
            active = np.flatnonzero(lo < hi)
            while active.size:
                mid = (lo[active] + hi[active]) >> 1
                theirs = mine[mid]
                less = np.where(odd[active], ~self.before(mine[active], theirs), self.before(theirs, mine[active]))
                lo[active] = np.where(less, mid + 1, lo[active])
                hi[active] = np.where(less, hi[active], mid)
                active = active[lo[active] < hi[active]]
            pair = start + (stretch & ~1) * width
            to = pair + (local - stretch * width) + (lo - other)
            fresh = np.empty(n, np.int64)
            fresh[to] = order
            order, width = fresh, 2 * width
        return order

    def agree(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` bytes from ``a`` and from ``b`` are equal."""
        out, words = np.empty(a.size, bool), np.lib.stride_tricks.sliding_window_view(self.text, length)
        for k in range(0, a.size, 1 << 13):
            part = slice(k, k + (1 << 13))
            out[part] = (words[a[part]] == words[b[part]]).all(axis=1)
        return out

    def repeated(self, at: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
        """Whether another suffix of the same bucket shares the first ``length`` bytes with each of ``at``.

        Buckets are sorted one after the other, small ones some at a time, so memory follows the largest bucket.
        """
        out = np.zeros(at.size, bool)
        by_bucket = np.argsort(bucket, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], np.diff(bucket[by_bucket]) != 0])) if at.size else np.zeros(0, np.int64)
        stops, low = [*begin[1:].tolist(), at.size] if at.size else [], 0
        for k, stop in enumerate(stops):
            if k + 1 == len(stops) or stops[k + 1] - low > TOGETHER:
                mine = by_bucket[low:stop]
                out[mine] = self._repeated(at[mine], bucket[mine], length)
                low = stop
        return out

    def _repeated(self, at: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
        order = self.sort(at, bucket)
        here, group = at[order], bucket[order]
        near = np.flatnonzero((group[1:] == group[:-1]) & (here[1:] != here[:-1]))
        near = near[self.agree(here[near], here[near + 1], length)]
        out = np.zeros(at.size, bool)
        out[order[near]] = out[order[near + 1]] = True
        return out
