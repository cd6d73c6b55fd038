"""Linking operators (1, 5) and I-Match (10) against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallywatch.llm import embedding_neardup, imatch, links, minhash_forest
from tallywatch.llm.tables import table

DOCS = "doc_id long, text string, lang string, node string, family int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reach(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def frame(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, "en", "x", 1) for k, t in enumerate(texts)], DOCS)


def shingles(text, k):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def expected_components(texts, near):
    sets = [shingles(t, near.words) for t in texts]
    pairs = [
        (a, b)
        for a, b in itertools.combinations(range(len(texts)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= near.percent * len(sets[a] | sets[b])
    ]
    return [len(s) for s in sets], reach(range(len(texts)), pairs)


def near_copies(seed, groups=12, copies=14, words=120):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for c in range(copies):
            some = list(base)
            for _ in range(rng.randrange(0, 7)):
                some[rng.randrange(words)] = f"e{rng.randrange(4000)}"
            out.append((" \n" if c % 3 == 0 else " ").join(some).upper() if c % 5 == 0 else " ".join(some))
    return out


@pytest.mark.parametrize("near", [minhash_forest.Near(words=3, percent=85), minhash_forest.Near(words=3, percent=85, region=8, block=10), minhash_forest.Near()])
def test_near_duplicates_equal_brute_force(spark, near):
    texts = [*near_copies(1), "", None, " \t\n", "one", "ONE", "one two", "one two", "\x1cone", "long " * 20_000]
    sizes, component = expected_components(texts, near)
    rows = {r.doc_id: r for r in minhash_forest.near_duplicates(frame(spark, texts), near).collect()}
    assert {k: r.n_shingles for k, r in rows.items()} == dict(enumerate(sizes))
    assert {k: r.component_id for k, r in rows.items()} == component
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())


def test_pairs_in_a_loose_crowd_are_found(spark):
    near = minhash_forest.Near(words=1, percent=60, region=2, least_depth=1)
    shared, texts = [f"c{k}" for k in range(50)], []
    for k in range(150):
        own = [f"o{k}x{j}" for j in range(50)]
        texts += [" ".join(shared + own), " ".join(shared + own[23:] + [f"p{k}x{j}" for j in range(23)])]
    texts += [" ".join(shared + [f"s{k}x{j}" for j in range(50)]) for k in range(100)]
    _, component = expected_components(texts, near)
    assert sum(k != c for k, c in component.items()) == 150
    assert {r.doc_id: r.component_id for r in minhash_forest.near_duplicates(frame(spark, texts), near).collect()} == component


def test_near_duplicates_of_awkward_rows(spark):
    assert minhash_forest.near_duplicates(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f", "en", "x", 1), (7, "a b c d e f", "en", "x", 1), (7, "a b c d e f", "en", "x", 1), (9, "A b c d e f", None, None, None)]
    got = sorted(map(tuple, minhash_forest.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False)], key=str)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    edges = chain + [(0, k) for k in range(1, 30)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(150)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == reach({x for e in real for x in e}, real)
    assert links.components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def vectors(seed, n=240, size=24):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((12, size))
    return [(int(k), (base[k % 12] + rng.standard_normal(size) * rng.choice([0.05, 0.15, 0.2])).astype("f4").tolist(), int(k % 3)) for k in range(n)]


@pytest.mark.parametrize("block", [4096, 16])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_neardup, "BLOCK", block)
    rows = vectors(1)
    x = np.array([v for _, v, _ in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if rows[a][2] == rows[b][2] and x[a] @ x[b] >= 0.98]
    assert pairs
    count = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    family = reach(range(len(rows)), pairs)
    got = embedding_neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {(k, int(count[k]), family[k], family[k] == k) for k in range(len(rows))}


def test_vectors_that_cannot_link(spark):
    v, inf, nan = [1.0, 2.0], float("inf"), float("nan")
    rows = [(1, v, 1), (2, v, 2), (3, v, None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [inf, 1.0], 1), (8, [nan, 1.0], 1), (9, [1.0, 2.0, 0.0], 1), (10, [], 1), (11, [2.0, 4.0], 1), (11, [2.0, 4.0], 1), (None, v, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit(1)).withColumn("mark", F.lit(2))
    got = sorted(map(tuple, embedding_neardup.near_duplicates(df).collect()), key=str)
    lone = [(k, 0, k, True) for k in range(2, 11)]
    assert got == sorted([(1, 1, 1, True), *lone, (11, 1, 1, False), (11, 1, 1, False), (None, 0, None, True)], key=str)
    assert embedding_neardup.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_within_their_bound():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((300, 48))
    b = a + rng.standard_normal(a.shape) * 0.1
    unit = np.concatenate([a, b]) / np.linalg.norm(np.concatenate([a, b]), axis=1, keepdims=True)
    codes, rows = embedding_neardup.Codes(unit), slice(0, 300)
    exact, seen = unit[rows] @ unit.T, codes.estimates(rows)
    close = exact >= 0.98
    assert close.sum() > 500
    assert (seen >= codes.least(rows, 0.98)[:, None])[close].all()
    assert abs((seen - exact)[~close].mean()) < 0.01


# --- I-Match ---------------------------------------------------------------------------------


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def fingerprint(text, kept_buckets):
    """The operator's rule, in plain Python: (level, own, next, rest)."""
    words = {w for w in re.split(r"[^\w]+|_+", text.lower()) if w}
    hashes = sorted(signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in words)
    kept = [h for h in hashes if h & 0xFFFFF in kept_buckets]
    at = lambda s: [h for h in kept if ((h & (1 << 64) - 1) >> 25) & ((1 << 2 * s) - 1) == 0]
    level = next((s for s in range(12) if len(at(s)) <= 32), 12)
    groups = lambda some: [tuple(h for h in some if (h & (1 << 64) - 1) >> 20 & 31 == j) for j in range(32)]
    return level, groups(at(level)), groups(at(level + 1)), not kept


def test_imatch_equals_plain_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    band = imatch.Band()
    bitmap = imatch.lexicon(docs, band).first()["bitmap"]
    kept = {64 * k + j for k, word in enumerate(bitmap) for j in range(64) if word >> j & 1}
    texts = [r.text for r in docs.orderBy("doc_id").select("text").collect()]
    ids = [r.doc_id for r in docs.orderBy("doc_id").select("doc_id").collect()]
    df = {}
    for t in texts:
        for b in {signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) & 0xFFFFF for w in re.split(r"[^\w]+|_+", t.lower()) if w}:
            df[b] = df.get(b, 0) + 1
    assert kept == {b for b, n in df.items() if band.low <= np.log(len(texts) / n) <= band.high}

    rows = {r.doc_id: r for r in imatch.edit_report(docs).collect()}
    edited = [t[: len(t) - len(t) // 4] + texts[(k + 1) % len(texts)][: len(t) // 4] for k, t in enumerate(texts)]
    assert [rows[i].edited for i in ids] == edited

    def alike(a, b):
        if a[3] or b[3]:
            return None
        gap = a[0] - b[0]
        sides = {0: [(a[1], b[1]), (a[2], b[2])], 1: [(a[1], b[2])], -1: [(a[2], b[1])]}.get(gap, [])
        pairs = [(x, y) for p, q in sides for x, y in zip(p, q, strict=True) if x or y]
        return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0

    prints = [fingerprint(t, kept) for t in texts]
    for k, i in enumerate(ids):
        mine, other = prints[k], fingerprint(edited[k], kept)
        assert rows[i].fp.level == mine[0] and [h == 0 for h in rows[i].fp.own] == [not g for g in mine[1]]
        want = alike(mine, other)
        assert want is None or rows[i].near_edited == pytest.approx(want)
        want = alike(mine, prints[(k + 1) % len(ids)])
        assert want is None or rows[i].near_next == pytest.approx(want)


def test_successors_and_awkward_texts(spark):
    rows = [(5, "five five"), (None, None), (3, "abcd" * 3), (3, "abcd" * 3), (9, ""), (-4, "é" * 9)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, _key int")
    got = imatch.edit_report(docs).collect()
    ordered = [(None, ""), (-4, "é" * 9), (3, "abcd" * 3), (3, "abcd" * 3), (5, "five five"), (9, "")]
    want = sorted(((i, t, t[: len(t) - len(t) // 4] + ordered[(k + 1) % 6][1][: len(t) // 4]) for k, (i, t) in enumerate(ordered)), key=str)
    assert sorted(((r.doc_id, r.text, r.edited) for r in got), key=str) == want
    assert imatch.edit_report(docs.limit(0)).count() == 0
    one = imatch.edit_report(docs.filter("doc_id = 5")).first()
    assert one.edited == "five fi" + "fi" and one.near_next == 1.0
    prints = docs.select("doc_id", "text")
    same = {r.text: r.f for r in imatch.edit_report(prints).select("text", imatch.fingerprint_text("fp").alias("f")).collect()}
    assert len({hashlib.md5(f.encode()).hexdigest() for f in same.values()}) == len(same)


def test_imatch_uses_no_python(spark, sf_dir):
    report = imatch.edit_report(table(spark, sf_dir, "documents"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("name", ["op1_embedding_neardup", "op5_minhash_forest"])
def test_queries_equal_their_sql(spark, name):
    from tallywatch.llm.queries import ORACLES, QUERIES
    from tests.oracle_check import compare, duck

    folder = "/root/testdata/sf0.01"
    assert not compare(spark, duck(folder), name, QUERIES[name], ORACLES[name], folder)
