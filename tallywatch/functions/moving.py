"""Mean, deviation and spread over the last rows of a price series, for prices of any finite size.

Each window is summed anew, oldest price first, in two-part floats: the rounding error of every addition is kept in a second
sum, so the result is as good as sums of twice the precision, and nothing of a price that has left the window stays behind.
Windows of very large or very small prices are first scaled by a power of two, which rounds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallywatch.session import travels_by_value

travels_by_value(__name__)

# Windows whose largest price lies beyond these powers of two are scaled, so that squares neither overflow nor vanish.
LARGE, SMALL = 2.0**500, 2.0**-400
SHRINK, GROW = 2.0**-600, 2.0**600


def two_part_sum(terms: Iterator[np.ndarray], size: int) -> np.ndarray:
    """Sums of the terms in their order, element by element."""
    high, low = np.zeros(size), np.zeros(size)
    for x in terms:
        total = high + x
        part = total - high
        low += (high - (total - part)) + (x - part)
        high = total
    return high + low


def moving_statistics(price: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, mean, percent deviation of the price from the mean, and population deviation, of the last ``width`` prices at each price.

    ``before`` holds the prices before the first one: the last ``width - 1``, or all where there are fewer. The
    deviation from a mean of zero is NaN.
    """
    n, before = price.size, before[before.size - min(before.size, width - 1) :]
    rows = np.minimum(np.arange(1, n + 1) + before.size, width)
    series = np.concatenate([np.zeros(width - 1 - before.size), before, price])
    absent = width - rows  # the oldest places of a window that begins before the series

    def each(scale: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(width):
            yield series[k : k + n] * scale, k >= absent

    largest = np.zeros(n)
    for k in range(width):
        np.maximum(largest, np.abs(series[k : k + n]), out=largest)
    scale = np.where(largest >= LARGE, SHRINK, np.where((largest < SMALL) & (largest > 0), GROW, 1.0))
    mean = two_part_sum((x for x, _ in each(scale)), n) / rows
    off = two_part_sum((np.where(there, x - mean, 0.0) for x, there in each(scale)), n)
    squares = two_part_sum((np.where(there, (x - mean) * (x - mean), 0.0) for x, there in each(scale)), n)
    spread = np.maximum(squares - off * off / rows, 0.0) / rows
    with np.errstate(divide="ignore", invalid="ignore"):
        deviation = np.where(mean == 0, np.nan, (price * scale - mean) / mean * 100.0)
    return rows, mean / scale, deviation, np.sqrt(spread) / scale
