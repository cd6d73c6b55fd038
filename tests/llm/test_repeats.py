"""Suffix sorting and repeated passages (4), and the pipeline, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywatch.llm import suffix_dedup
from tallywatch.llm.suffix_sort import Block
from tallywatch.llm.tables import stored, table
from tests.llm.test_pairs import expected_components
from tallywatch.llm.minhash_forest import Near


@pytest.mark.parametrize("seed", range(40))
def test_suffixes_are_sorted(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 900))
    text = bytes(rng.integers(0, 1 + seed % 3, n).astype("u1")) if seed % 2 else bytes((rng.integers(0, 2, 30).astype("u1").tolist() * 40)[:n])
    n = len(text)
    at, bucket = np.arange(n), np.arange(n) % (1 + seed % 4)
    assert Block(text).sort(at, bucket).tolist() == sorted(range(n), key=lambda k: (bucket[k], text[k:]))
    some = np.arange(max(0, n - 99))
    if some.size:
        seen = Counter((bucket[k], text[k : k + 100]) for k in some)
        assert Block(text).repeated(some, bucket[some], 100).tolist() == [seen[bucket[k], text[k : k + 100]] > 1 for k in some]


def covered(bodies, length):
    seen = Counter(b[k : k + length] for b in bodies for k in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        out.append(gone)
    return out


def passages(seed, n=150):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(rng.choice([30, 42, 60, 90]))) for _ in range(6)]
    out = []
    for k in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), " ".join(word() for _ in range(rng.randint(0, 30)))]
        out.append(" ".join(parts))
    return [*out, out[0], out[1], shared[0], "ab" * 400, "x" * 3000, "x" * 199, "x" * 200, "", None, "short"]


@pytest.mark.parametrize("repeats", [suffix_dedup.Repeats(), suffix_dedup.Repeats(block=3000), suffix_dedup.Repeats(crowd=3), suffix_dedup.Repeats(length=120, gram=16, crowd=2)])
def test_removed_bytes_equal_brute_force(spark, repeats):
    texts = passages(1)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, gram string, place int")
    rows = {r.row.doc_id: r for r in suffix_dedup.without_repeats(docs, repeats).collect()}
    bodies = [(t or "").encode() for t in texts]
    for k, (body, gone) in enumerate(zip(bodies, covered(bodies, repeats.length), strict=True)):
        mine = np.zeros(len(body), bool)
        for run in rows[k].removed:
            assert not mine[max(0, run.start - 1) : run.end + 1].any()
            mine[run.start : run.end] = True
        assert (mine == gone).all(), k
        assert bytes(rows[k].kept) == np.frombuffer(body, "u1")[~gone].tobytes() and rows[k].n_bytes == len(body)
        assert rows[k].row.gram == "x"


def test_rows_that_share_an_id_are_documents_apart(spark):
    long = " ".join(f"word{k}" for k in range(60))
    other = " ".join(f"more{k}" for k in range(60))
    docs = spark.createDataFrame([(1, long), (1, long), (2, other), (2, "none of it"), (None, long), (None, None)], "doc_id long, text string")
    rows = suffix_dedup.without_repeats(docs).collect()
    assert sorted((r.row.doc_id or 0, len(r.kept)) for r in rows) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, len("none of it")), (2, len(other))]
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0


def test_many_texts_of_one_id_and_of_none(spark):
    rng = random.Random(8)
    word = lambda n: " ".join(f"{rng.randrange(1 << 40):x}" for _ in range(n))
    shared = [word(30) for _ in range(20)]
    texts = [" ".join([word(rng.randrange(1, 9)), rng.choice(shared), word(rng.randrange(1, 9))]) for _ in range(900)]
    texts += [texts[0]] * 60 + [word(40)] + ["short"] * 5
    rows = [(i, t) for i in (7, None) for t in texts] + [(7, word(50))] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    bodies = [t.encode() for _, t in rows]
    want = Counter((i, b, np.frombuffer(b, "u1")[~g].tobytes()) for (i, _), b, g in zip(rows, bodies, covered(bodies, 200), strict=True))
    got = suffix_dedup.without_repeats(docs).collect()
    assert Counter((r.row.doc_id, r.row.text.encode(), bytes(r.kept)) for r in got) == want
    assert all(r.n_bytes - sum(x.end - x.start for x in r.removed) == len(r.kept) for r in got)
    size = F.aggregate("starts", F.lit(0), lambda total, x: total + F.octet_length(x))
    assert suffix_dedup.spans(docs).agg(F.max(size)).first()[0] <= 16 * max(map(len, bodies))


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    docs = stored(table(spark, sf_dir, "documents").withColumn("row", F.lit("extra")).withColumn("score", F.lit(1)), "test")
    quality, near, cut, pack = (f for _, f in corpus_pipeline.STAGES)
    good = stored(quality(spark, docs, sf_dir), "test")
    assert good.schema == docs.schema
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    kept = {r.doc_id for r in good.collect()}
    clean = [d for d, q in labels.items() if q]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)
    assert sum(d not in kept for d, q in labels.items() if not q) >= 0.6 * sum(not q for q in labels.values())  # learned from 7 bad rows

    once = stored(near(spark, good, sf_dir), "test")
    assert once.schema == docs.schema
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    _, component = expected_components([t for _, t in rows], Near())
    assert sorted(r.doc_id for r in once.collect()) == [rows[k][0] for k, c in component.items() if k == c]

    left = stored(cut(spark, once, sf_dir), "test")
    assert left.schema == docs.schema
    before = {r.doc_id: r for r in once.collect()}
    gone = covered([before[d].text.encode() for d in sorted(before)], 200)
    want = {}
    for d, g in zip(sorted(before), gone, strict=True):
        text = np.frombuffer(before[d].text.encode(), "u1")[~g].tobytes().decode(errors="ignore")
        if text or not g.any():
            want[d] = text
    assert {r.doc_id: r.text for r in left.collect()} == want
    assert all(r.n_chars == len(r.text) for r in left.collect())

    packed = pack(spark, left, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(want)


def test_pipeline_of_awkward_rows(spark, sf_dir):
    rows = [(1, "a b c d e f", "en", "s", 11), (1, "a b c d e f", "en", "s", 11), (None, None, None, None, None), (None, "", "en", None, 0), (2, None, None, None, None), (3, "long " * 9000, "en", "s", 45_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    _, near, cut, pack = (f for _, f in corpus_pipeline.STAGES)
    once = stored(near(spark, docs, sf_dir), "test")
    assert sorted((r.doc_id or 0) for r in once.collect()) == [0, 0, 1, 2, 3]
    left = stored(cut(spark, once, sf_dir), "test")
    assert sorted((r.doc_id or 0, r.text) for r in left.collect() if r.text) == [(1, "a b c d e f")]
    assert pack(spark, left, sf_dir).count() == left.count()
    none = docs.limit(0)
    for stage in (near, cut, pack):
        assert stage(spark, none, sf_dir).count() == 0


def test_near_stage_compares_texts_that_share_an_id_or_have_none(spark, sf_dir):
    one, two, three = (" ".join(f"{w}{k}" for k in range(30)) for w in "abc")
    rows = [(1, one), (1, two), (1, two), (4, two), (None, three), (None, three), (None, one), (6, three)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    assert sorted(map(tuple, got)) == [(1, one), (1, two), (6, three)]


def test_registered_queries(spark, sf_dir):
    from tallywatch.llm.queries import ORACLES, QUERIES

    assert sorted(QUERIES) == sorted(["pipeline", *(q for q in QUERIES if q.startswith("op"))]) and len(QUERIES) == 11
    assert set(ORACLES) <= set(QUERIES)
    n_docs, n_pages = table(spark, sf_dir, "documents").count(), table(spark, sf_dir, "pages").count()
    for name, rows in (("op2_html_extract", n_pages), ("op4_suffix_dedup", n_docs), ("op6_compression_quality", n_docs)):
        assert QUERIES[name](spark, sf_dir).count() == rows
