"""Hard negatives against a plain search over all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string"


def expected(rows: list[tuple], positives: int = 5, negatives: int = 3, every: int = 4) -> set[tuple]:
    good = set()
    for i, v, label, _ in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good.add((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), label))
    out = set()

    def dot(a, b):
        return max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(a, b, strict=True))))

    for i, v, label in (r for r in good if r[0] % every == 0):
        others = [(dot(v, w), j, m) for j, w, m in good if j != i and len(w) == len(v)]
        near = sorted(((s, j) for s, j, m in others if m == label), key=lambda t: (-t[0], t[1]))[:positives]
        # a label of its own decides what a negative is, so another row of the same id can be one
        far = sorted(((dot(v, w), j) for j, w, m in good if m != label and len(w) == len(v)), key=lambda t: (-t[0], t[1]))
        for p, j in near:
            inside = [(s, k) for s, k in far if 50 * p <= 100 * s <= 95 * p][:negatives]
            out |= {(i, j, n + 1, k, p, s) for n, (s, k) in enumerate(inside)}
    return out


def found(spark, rows: list[tuple], **how) -> set[tuple]:
    df = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 4 == 0, **how)
    out = [tuple(r) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


def vectors(rng: random.Random, n: int, d: int, labels: int) -> list[tuple]:
    hubs = [[rng.gauss(0, 0.2) for _ in range(d)] for _ in range(5)]
    return [(k, [h + rng.gauss(0, 0.1) for h in rng.choice(hubs)], rng.randrange(labels), "x") for k in range(n)]


def test_like_all_pairs(spark, monkeypatch):
    rows = vectors(random.Random(3), 300, 24, 3)
    want = expected(rows)
    assert len(want) > 300
    assert found(spark, rows) == want
    monkeypatch.setattr(hard_negatives, "BLOCK", 32)
    monkeypatch.setattr(hard_negatives, "PACK", 8)
    monkeypatch.setattr(hard_negatives, "FEW", 0.0005)
    assert found(spark, rows) == want


def test_awkward_rows(spark):
    rng = random.Random(5)
    rows = vectors(rng, 60, 6, 2)
    rows += [rows[8], rows[8], rows[9]]  # repeated rows
    rows += [(8, [0.5] * 6, 1, "y"), (8, [0.4] * 6, 0, None)]  # other rows of the same id
    rows += [(None, [0.1] * 6, 1, "n"), (100, None, 1, "n"), (104, [0.1] * 6, None, "n"), (108, [], 1, "n")]
    rows += [(112, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1, "n"), (116, [float("nan")] * 6, 1, "n"), (120, [float("inf")] * 6, 1, "n")]
    rows += [(124, [0.3] * 3, 1, "short"), (125, [0.3] * 3, 1, "short"), (126, [0.2] * 3, 0, "short"), (128, [0.0] * 6, 1, "zero")]
    rows += [(200, [1.0] * 6, 9, "alone")]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == set()


def test_large_components(spark):
    rng = random.Random(9)
    rows = [(k, [rng.uniform(-1, 1) * 10 ** rng.choice([1, 5, 6]) for _ in range(5)], k % 2, "x") for k in range(40)]
    assert found(spark, rows) == expected(rows)


def test_ties_and_copies_in_one_hot_label(spark):
    rows = [(k, [0.5, 0.5, 0.25], 1, "copy") for k in range(40)] + [(k, [0.25, 0.5, 0.25], k % 3, "other") for k in range(40, 60)]
    assert found(spark, rows) == expected(rows)


@pytest.mark.parametrize("low", [1.0, 400.0, 3000.0, -5.0])
def test_index_loses_no_pair(low):
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(0, 20, (200, 30)) * rng.uniform(0, 2, 30))
    anchors = np.floor(rng.normal(0, 20, (40, 30)) * rng.uniform(0, 2, 30))
    index = hard_negatives.index_of(rows, anchors, low)
    a, b, score = index.reach(anchors, np.full(40, low))
    exact = anchors @ rows.T
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(exact >= low)), strict=True))
    assert (score == exact[a, b]).all()
