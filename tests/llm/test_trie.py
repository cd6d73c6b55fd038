"""Prefix trie against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallywatch.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def name(role: str, text: str) -> str:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def expected(rows: list[tuple], rebuild: bool = True) -> set[tuple]:
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, name(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    convs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        convs[c] = tuple(own.get(base, [])[:h] + v[h:])
    if not convs:
        return set()
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, path in convs.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    saved, leaves = defaultdict(int), defaultdict(int)
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] += (len(members[path]) - 1) * words
        leaves[path] += not children[path]
        if path:
            saved[path[:-1]] += saved[path]
            leaves[path[:-1]] += leaves[path]
    return {
        (
            min(members[p]),
            len(p),
            min(members[p[:-1]]) if p else None,
            len(members[p]),
            len(children[p]),
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p in members
    }


def found(spark, rows: list[tuple], rebuild: bool = True, **how) -> set[tuple]:
    placed = prefix_trie.turns(spark.createDataFrame(rows, SCHEMA))
    if rebuild:
        heads = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
        placed = prefix_trie.rebuilt(placed, 3, heads, F.col("conv") - F.col("conv") % 20)
    out = [tuple(r) for r in prefix_trie.report(placed, **how).collect()]
    assert len(out) == len(set(out))
    return set(out)


def talks(rng: random.Random, n: int, deep: int) -> list[tuple]:
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, deep)):
            rows.append((c, t, rng.choice(["user", "bot"]), " ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(3))), "x"))
    return rows


def test_like_plain_python(spark, monkeypatch):
    rows = talks(random.Random(2), 120, 7)
    want = expected(rows)
    assert found(spark, rows) == want
    # nodes of a family over several shards, and queues that spill
    monkeypatch.setattr(prefix_trie, "FAMILY", 1)
    monkeypatch.setattr(prefix_trie, "LEVELS", 2)
    monkeypatch.setattr(prefix_trie, "SLICE", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    assert found(spark, rows, queue=3, shards=7) == want


def test_awkward_rows(spark):
    rows = [
        (None, 1, "user", "no id", "x"),
        (5, None, None, None, "x"),
        (5, None, None, None, "x"),  # a repeated row is a turn of its own
        (5, 2, "user", "later", None),
        (5, 2, "user", "later than", None),  # a tie
        (25, 1, "user", "", "x"),
        (-3, 7, "user", "negative id", "x"),
        (40, 1, "user", "w " * 50_000, "long"),
        (41, 1, "user", "w " * 50_000, "long"),
        (60, 1, "12:", "a", "x"),
        (80, 1, "12", ":a", "x"),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, rows[:1]) == set() == expected(rows[:1])
    assert found(spark, []) == set()


def test_hot_prefix_and_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLICE", 16)
    monkeypatch.setattr(prefix_trie, "LEVELS", 16)
    rows = [(1000 + c, t, "user", f"same {t}" if t < 2 else f"own {c % 40}", "x") for c in range(150) for t in range(3)]
    rows += [(7, t, "user", f"line {t % 3}", "x") for t in range(220)]  # a third of all rows
    assert found(spark, rows, rebuild=False, queue=8, shards=5) == expected(rows, rebuild=False)


@pytest.mark.parametrize("most", [2, 5, 1000])
def test_queue_in_order(most):
    rng = random.Random(most)
    queue, out, held = prefix_trie.SpillingQueue(most), [], 0
    for k in range(400):
        queue.push((k + rng.randrange(50), k, 0, 0, 0, 0))
        held += 1
        if rng.random() < 0.3:
            assert queue.peek() == (head := queue.pop())
            out.append(head)
            held -= 1
    rest = [queue.pop() for _ in range(held)]
    assert queue.peek() is None and rest == sorted(rest) and len({*out, *rest}) == 400
