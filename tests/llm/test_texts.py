"""Operators on single texts (2, 3, 6, 7, 8, 9) against libraries, brute force and held-out rows."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import byte_ids, compression_quality, html_extract, length_packing, piece_bpe, tables, token_counts, wavelet_ids
from tallywatch.llm.tables import table
from tallywatch.session import scratch_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ATOMS = [*"abcdehilnorst   ", "the", "ing", "  ", "\n", "\t", "▁", "é", "中", "😀", "1", "23", "!", "'s", "'ll", "</s>", "<0x0A>", "<|endoftext|>", ".", ",", "\x00", "�", "\x1c", "    ", "ſ", "²"]


def drawn(seed, n, most=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(ATOMS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_BPE)


def awkward(spark):
    rows = [(3, "same text", 1), (3, "same text", 2), (None, "no id", 3), (1, None, 4), (2, "", 5), (9, "very long " * 30_000, 6)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int").withColumn("part", F.lit("x")).withColumn("row", F.lit(1))


# --- 7 ---------------------------------------------------------------------------------------


def test_pieces_equal_the_library():
    from sentencepiece import SentencePieceProcessor

    model, ours = SentencePieceProcessor(model_file=PIECES), piece_bpe.PieceEncoder(PIECES)
    for text in drawn(1, 5000):
        ids = np.frombuffer(ours.encode(text), "<i4").tolist()
        assert ids == model.encode(text, add_eos=True), repr(text)
        assert ours.pieces.decode(ids) == model.decode(ids), repr(text)
    rng = np.random.default_rng(2)
    for k in range(2000):
        ids = rng.integers(0, 400 if k % 2 else 32_000, 8).tolist()
        assert ours.pieces.decode(ids) == model.decode(ids), ids


def test_pieces_of_tables(spark, sf_dir):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    for docs in (table(spark, sf_dir, "documents"), awkward(spark)):
        got = piece_bpe.decode(piece_bpe.encode(docs, PIECES), PIECES).collect()
        want = [(r.doc_id, model.encode(r.text or "", add_eos=True)) for r in docs.collect()]
        assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(want, key=str)
        assert all(r.decoded == model.decode(r.ids) for r in got)
    assert piece_bpe.encode(awkward(spark).limit(0), PIECES).count() == 0


# --- 8 ---------------------------------------------------------------------------------------


def test_byte_ids_equal_the_library(tokenizer):
    ours = byte_ids.ByteIds(BYTE_BPE, limit=300)
    for text in drawn(3, 8000):
        assert np.frombuffer(ours.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_known_words_are_not_encoded_again_with_what_follows_them(tokenizer):
    """Round 3: a word before several other signs was given to the library anew for each of them."""
    ours, asked = byte_ids.ByteIds(BYTE_BPE), []
    library = ours.model

    class Counted:
        def tokenize(self, text):
            asked.append(text)
            return library.tokenize(text)

    ours.model = Counted()
    text = "a streha streha,### streha$$$ streha's streha\nstreha"
    assert np.frombuffer(ours.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert asked.count(ours.space + "streha") == 1


def test_words_are_kept_without_the_signs_after_them(tokenizer):
    """Round 3: a worker kept a word once for each sign and each next line after it, which pushed other words out."""
    ours, rng = byte_ids.ByteIds(BYTE_BPE), random.Random(8)
    text = "a streha, streha. streha.\nStreha, streha b"
    assert np.frombuffer(ours.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert [piece for piece in ours.after_space if "streha" in piece] == ["streha"]
    parts = [", ", ". ", ".\n", "a", "b", "\u00e9", "\u0301", " ", "  ", "\n", "\0", "1", "'s", "'", ".", ",", "!", "\u6f22", "\u3000", "..."]
    counts = byte_ids.ByteCounts(BYTE_BPE)
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.encode(text), "<u2").tolist() == want and counts.encode(text) == len(want), repr(text)


@pytest.mark.parametrize("n", [0, 1, 7, 1024, 1025, 40_000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50_257).astype("<u2")
    ends = np.array([n // 3, n // 3, n])
    shard = wavelet_ids.Shard(wavelet_ids.write_shard(ids, [5, None, -7], ends))
    assert (shard.matrix.all() == ids).all() and shard.doc_ids == [5, None, -7] and shard.ends.tolist() == ends.tolist()
    assert [shard.matrix.access(int(k)) for k in range(0, n, max(1, n // 40))] == ids[:: max(1, n // 40)].tolist()
    for token in (0, 1, 2, 3, 50, 50_256, 70_000):
        at = np.flatnonzero(ids == token)
        assert shard.matrix.count(token) == at.size and (shard.matrix.occurrences(token) == at).all()


@pytest.mark.parametrize("shard_ids", [1 << 20, 700])
def test_written_ids_come_back(spark, sf_dir, tokenizer, shard_ids):
    for docs in (table(spark, sf_dir, "documents"), awkward(spark), awkward(spark).limit(0)):
        path = scratch_dir(spark, "ids")
        wavelet_ids.write_ids(docs, path, BYTE_BPE, shard_ids=shard_ids)
        got = {(r.start, r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in wavelet_ids.with_start(wavelet_ids.read_ids(spark, path), path).collect()}
        want, start = set(), 0
        for doc, text in sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
            ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
            want.add((start, doc, ids.size, zlib.crc32(ids.tobytes())))
            start += ids.size
        assert got == want


# --- 3 ---------------------------------------------------------------------------------------


def test_recounts_equal_full_counts(tokenizer):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BYTE_BPE)
    plain.encode_special_tokens = True
    counter, rng = token_counts.Counter(BYTE_BPE), random.Random(4)
    for text in drawn(4, 300, 300):
        tree = token_counts.Tree.of(text, counter)
        for _ in range(5):
            at, gone = rng.randint(0, len(text)), rng.randint(0, 5 if rng.random() < 0.9 else 200)
            text = tree.replace(text, at, gone, "".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 4))), counter)
            assert tree.total == len(plain.encode(text, add_special_tokens=False).ids)
        again = token_counts.Tree.from_bytes(tree.to_bytes())
        assert again.total == tree.total and int(again.sums[1, 0]) == len(text)


def test_recounts_of_tables(spark, sf_dir, tokenizer):
    docs = table(spark, sf_dir, "documents").withColumn("edits", token_counts.drawn_edits())
    rows = token_counts.recount(token_counts.count(docs, BYTE_BPE, edits_col="edits"), BYTE_BPE).collect()
    old = {r.doc_id: r for r in docs.collect()}
    assert len(rows) == len(old)
    for r in rows:
        text = old[r.doc_id].text
        assert r.n_tokens == len(tokenizer.encode(text, add_special_tokens=False).ids)
        for e in old[r.doc_id].edits:
            text = text[: e.at] + e.inserted + text[e.at + e.deleted :]
        assert r.text == text and r.n_edited == len(tokenizer.encode(text, add_special_tokens=False).ids)
    assert sum(r.n_encoded for r in rows) < 0.2 * sum(r.n_tokens for r in rows)


def test_recounts_of_awkward_rows(spark):
    edits = F.expr(f"cast(array(null, named_struct('at', 99999999, 'deleted', 5, 'inserted', 'x y'), named_struct('at', null, 'deleted', null, 'inserted', null)) as {token_counts.EDITS})")
    rows = token_counts.recount(token_counts.count(awkward(spark).withColumn("edits", edits), BYTE_BPE, edits_col="edits"), BYTE_BPE).collect()
    assert len(rows) == 6 and all(r.text.endswith("x y") for r in rows)
    none = token_counts.recount(token_counts.count(awkward(spark), BYTE_BPE), BYTE_BPE).collect()
    assert all(r.n_edited == r.n_tokens and r.n_encoded == 0 for r in none)
    assert token_counts.count(awkward(spark).limit(0), BYTE_BPE).count() == 0


# --- 9 ---------------------------------------------------------------------------------------


def test_boundaries_are_optimal():
    rng = np.random.default_rng(6)
    for _ in range(300):
        counts, k = rng.integers(0, 4, int(rng.integers(2, 10))), int(rng.integers(1, 4))
        counts[0] = 0
        used = np.flatnonzero(counts)
        ends = length_packing.boundaries(counts, k)
        padding = lambda e: sum(int(counts[n]) * (min(x for x in e if x >= n) - int(n)) for n in used)
        if used.size:
            assert len(ends) <= k
            assert padding(ends) == min(padding({*some, used[-1]}) for some in itertools.combinations(used.tolist(), min(k, used.size) - 1))


def test_packing_holds_every_token_once(spark, sf_dir, tokenizer):
    docs = table(spark, sf_dir, "documents")
    packing = length_packing.Packing(longest=256, buckets=5, budget=2048, slice=60)
    rows = length_packing.pack_texts(docs, BYTE_BPE, packing).collect()
    whole = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in docs.collect()}
    by_doc, batches = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.piece))
        batches.setdefault(r.batch, []).append(r)
        assert r.n_tokens <= r.boundary <= 256
    for doc, n in whole.items():
        assert [(256 * p, min(256, n - 256 * p), p) for p in range(-(-n // 256))] == sorted(by_doc[doc])
    for held in batches.values():
        assert len({r.bucket for r in held}) == 1 and len(held) * held[0].boundary <= 2048
        assert sorted(r.place for r in held) == list(range(len(held)))
    slices = {tuple(name.split("-")[:2]) for name in batches}
    not_full = sum(len(held) < 2048 // held[0].boundary for held in batches.values())
    assert not_full <= len(slices)


def test_counts_are_those_of_the_ids_and_are_all_that_is_kept():
    """Round 3: packing kept the ids of every piece, though it only counts them."""
    counts, ids = byte_ids.ByteCounts(BYTE_BPE, limit=300), byte_ids.ByteIds(BYTE_BPE)
    for text in ["", *drawn(5, 3000)]:
        assert counts.encode(text) == len(ids.encode(text)) // 2, repr(text)
    assert all(type(n) is int for memo in (counts.pretoken, counts.after_space) for n in [*memo.values(), *memo.older.values()])


def test_workers_drop_what_another_operator_kept():
    """Round 3: an encoder's memo stayed in the workers throughout the pipeline's other stages."""
    made = []

    def task(*keys):
        with tables._same_operator():
            return [tables.kept_by_worker(k, lambda k=k: made.append(k) or [k]) for k in keys]

    first, again, _, later = task("a"), task("a"), task(), task("a", "b", "a")
    assert first[0] is again[0] and later[0] is later[2] and later[0] is not first[0]
    assert made == ["a", "a", "b"] and not tables._former
    task()
    assert not tables._kept


def test_packing_of_awkward_rows(spark):
    rows = [(1, 5), (1, 5), (None, 7), (2, 0), (3, None), (4, 300)]
    got = length_packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens long"), length_packing.Packing(longest=100)).collect()
    assert sorted((r.doc_id or 0, r.start, r.n_tokens) for r in got) == [(0, 0, 7), (1, 0, 5), (1, 0, 5), (4, 0, 100), (4, 100, 100), (4, 200, 100)]
    assert len({(r.batch, r.place) for r in got}) == len(got)
    assert length_packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


# --- 6 ---------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = compression_quality.score(docs, compression_quality.learn(docs, labels))
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert scored.count() == docs.count() and len(rows) > 100
    assert {r.doc_id for r in rows} == {r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.9  # 14 bad rows, one of 30 characters
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        rows = compression_quality.score(docs, compression_quality.learn(docs, known)).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
        assert not next(r for r in rows if r.doc_id is None).held_out
    model = compression_quality.learn(docs, labels)
    assert compression_quality.score(docs.limit(0), model).count() == 0
    assert compression_quality.with_score(docs, model).select("row.*").columns == docs.columns


# --- 2 ---------------------------------------------------------------------------------------

PAGE = """<html><head><title>x</title></head><body><header class="site"><a href=/>Home</a> My site has words here, many words</header>
<div class="cookie-notice">We use cookies, please accept them all now</div><div id="main-text"><h1>Title &amp; more</h1>
<p>First  paragraph\n of <b>text</b> &lt;b&gt; with <a href="x>y">a link</a> inside&nbsp;it.</p><div class="ad-box">Buy now the best product that ever was made, and made well</div>
<script>var t = "</p><p>no</p>";</script><p>Second one<br>is here, long enough to be content.<p>Third, unclosed</div>
<aside><h3>Related</h3><ul><li><a href=1>One more</a></li></ul></aside><section class="comments"><p>Nice article, I liked it very much, thanks a lot for it.</p></section>
<form><label>Name</label><input></form><footer>&copy; 2020 all rights reserved by me and others</footer></body></html>"""


def by_markup(html):
    """The given pages mark their content; this reads it by that mark alone."""
    import re
    from html import unescape

    inside = re.search(r"<article>(.*?)</article>", html, re.DOTALL)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inside).replace("<br>", " "))
    return "\n".join(filter(None, (" ".join(unescape(b).split()) for b in blocks)))


def test_main_text_of_given_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    got = {r.page_id: r.text for r in html_extract.extract(pages, html_extract.learn(pages)).collect()}
    assert got == {r.page_id: by_markup(r.html) for r in pages.collect()}
    unmarked = pages.withColumn("html", F.regexp_replace("html", "</?article>", ""))
    again = {r.page_id: r.text for r in html_extract.extract(unmarked, html_extract.learn(pages)).collect()}
    assert again == got


def test_main_text_of_another_layout(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    want = "Title & more\nFirst paragraph of text <b> with a link inside it.\nSecond one is here, long enough to be content.\nThird, unclosed"
    for score in (html_extract.learn(pages), html_extract.learn(pages.limit(0))):
        assert html_extract.main_text(PAGE, score) == want


def test_awkward_pages(spark):
    htmls = [None, "", "plain words only < 3", "<p>a<p", "<!-- <p>x</p>", "<script>x", "<div " + "a='" * 50 + "<p>words and words</p>", "</p>" * 1000, "<p>" + "word " * 50_000]
    pages = spark.createDataFrame([(k if k else None, None, h, 1) for k, h in enumerate(htmls)], "page_id long, url string, html string, text int")
    score = html_extract.learn(pages)
    rows = {r.page_id: r for r in html_extract.extract(pages, score).collect()}
    assert len(rows) == len(htmls) and rows[None].text == "" and rows[1].text == ""
    assert rows[2].text == "plain words only < 3" and rows[8].text == ("word " * 50_000).strip()
    assert html_extract.extract(pages.limit(0), score).count() == 0


def test_best_run_is_the_best():
    class Stub:
        pass

    rng = random.Random(8)
    for _ in range(300):
        page = Stub()
        n = rng.randint(0, 12)
        page.kinds, page.weights, page.aside = [rng.choice("ab") for _ in range(n)], [rng.randint(1, 4) for _ in range(n)], [False] * n
        score = {"a": 1.0, "b": -1.5}
        each = [score[k] * w for k, w in zip(page.kinds, page.weights, strict=True)]
        a, b = html_extract.best_run(page, score)
        assert sum(each[a:b]) == max([0, *(sum(each[i:j]) for i in range(n) for j in range(i, n + 1))])
