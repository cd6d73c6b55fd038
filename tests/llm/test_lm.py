"""Language-model scores: word base and attention against plain loops, gradients against differences."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywatch.llm import attention_lm as lm
from tallywatch.llm import attention_net as net

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def weights(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {k: rng.normal(0, 0.3, shape).astype(np.float32) for k, shape in net.SHAPES.items()}


def some_net(seed: int = 3) -> net.Net:
    pairs = np.random.default_rng(seed).integers(0, 5, (net.SLOTS + 1, net.SLOTS))
    return net.Net(weights(seed), net.counted_table(pairs))


def plain_log_prob(n: net.Net, slots: list[int], t: int) -> float:
    """Log probability of slots[t + 1] by the formulas, one position at a time. ``slots`` begins with the opening one."""
    w = {k: v.astype(np.float64) for k, v in n.w.items()}
    start = max(0, t // net.STEP * net.STEP - net.BEFORE)
    x = w["embed"][slots[t]]
    seen = [w["embed"][s] for s in slots[start : t + 1]]
    scores = np.array([(x @ w["query"]) @ (e @ w["key"]) / math.sqrt(net.KEY) + w["distance"][t - start - k] for k, e in enumerate(seen)])
    share = np.exp(scores - scores.max())
    heard = sum(a * (e @ w["value"]) for a, e in zip(share / share.sum(), seen, strict=True))
    mixed = np.maximum(x @ w["mix_own"] + heard @ w["mix_seen"] + w["mix_bias"], 0)
    state = x + heard + mixed @ w["mix_out"]
    group, place = divmod(slots[t + 1], net.WITHIN)

    def log_share(logits, k):
        return logits[k] - logits.max() - np.log(np.exp(logits - logits.max()).sum())

    classes = state @ w["classes"] + n.class_table[slots[t]].astype(np.float64)
    within = state @ w["within"][group] + n.within_table[slots[t], group].astype(np.float64)
    return log_share(classes, group) + log_share(within, place)


@pytest.mark.parametrize("length", [1, 2, net.STEP, net.STEP + 1, 3 * net.STEP + 5])
def test_windows_score_each_position_once_like_plain_loops(length):
    n, rng = some_net(), np.random.default_rng(length)
    texts = [rng.integers(0, net.SLOTS, k).tolist() for k in (length, 1, 40)]
    stream = np.array([s for t in texts for s in [net.OPENS, *t]], np.int32)
    lengths = np.array([len(t) for t in texts])
    begin = np.cumsum(lengths + 1) - lengths - 1
    text, first, count = net.windows(lengths)
    assert [int(count[text == k].sum()) for k in range(3)] == lengths.tolist()
    seen, want = net.window_slots(stream, begin, text, first)
    valid = np.arange(net.STEP)[None, :] < count[:, None]
    at = np.flatnonzero(valid.ravel())
    got = n.log_probs(n.hidden(seen, first == 0)[at], seen[:, net.BEFORE :].ravel()[at], want.ravel()[at])
    plain = [plain_log_prob(n, [net.OPENS, *t], k) for t in texts for k in range(len(t))]
    assert got == pytest.approx(plain, abs=2e-4)


def test_probabilities_of_all_slots_sum_to_one():
    n = some_net()
    state = np.random.default_rng(0).normal(0, 1, (1, net.DIM)).astype(np.float32)
    logs = n.log_probs(np.repeat(state, net.SLOTS, 0), np.full(net.SLOTS, 17), np.arange(net.SLOTS))
    assert np.exp(logs.astype(np.float64)).sum() == pytest.approx(1, abs=1e-4)
    slot, rest = lm.slots_of(np.random.default_rng(1).integers(0, 100, lm.IDS))
    assert np.exp(rest[slot == lm.REST]).sum() == pytest.approx(1) and (rest[slot != lm.REST] == 0).all()


def test_very_large_weights_stay_finite():
    n = some_net()
    for v in n.w.values():
        v *= 50
    n.refresh()
    seen = np.random.default_rng(0).integers(0, net.SLOTS, (4, net.WIDTH))
    state = n.hidden(seen, np.array([True, False, False, False]))
    logs = n.log_probs(state, seen[:, net.BEFORE :].ravel(), np.arange(state.shape[0]))
    assert np.isfinite(state).all() and not np.isnan(logs).any()


def test_gradients_equal_differences():
    n, rng = some_net(), np.random.default_rng(2)
    seen, want = rng.integers(0, 60, (3, net.WIDTH)), rng.integers(0, net.SLOTS, (3, net.STEP))
    opening, valid = np.array([True, False, False]), rng.random((3, net.STEP)) < 0.8
    _, g = n.gradients(seen, opening, valid, want)
    used = {"embed": (int(seen[1, 3]), 2), "distance": (3,), "within": (int(want[0, 0]) // net.WITHIN, 1, 4)}
    for name, shape in net.SHAPES.items():
        at = used.get(name, tuple(s // 2 for s in shape))
        losses = []
        for step in (1e-2, -1e-2):
            n.w[name][at] += np.float32(step)
            n.refresh()
            losses.append(n.gradients(seen, opening, valid, want)[0])
            n.w[name][at] -= np.float32(step)
        n.refresh()
        assert g[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-2, rel=0.05, abs=2e-4), name


class Counted(np.ndarray):
    """An array that counts its gathers."""

    gathers: Counter = Counter()

    def take(self, *args, **kwargs):
        Counted.gathers[id(self)] += 1
        return np.asarray(self).take(*args, **kwargs)


def test_a_step_gathers_queries_keys_and_values_once():
    n, rng = some_net(), np.random.default_rng(4)
    seen, want = rng.integers(0, net.SLOTS, (5, net.WIDTH)), rng.integers(0, net.SLOTS, (5, net.STEP))
    opening, valid = np.arange(5) == 2, rng.random((5, net.STEP)) < 0.8
    loss, plain = n.gradients(seen, opening, valid, want)
    tables = n.q, n.k, n.v, n.v_one = [x.view(Counted) for x in (n.q, n.k, n.v, n.v_one)]
    Counted.gathers.clear()
    again, g = n.gradients(seen, opening, valid, want)
    assert [Counted.gathers[id(x)] for x in tables] == [1, 1, 0, 1]
    assert again == loss and all(np.array_equal(g[name], plain[name]) for name in net.SHAPES)


def test_adam_moves_each_weight_by_the_formula():
    rng, w = np.random.default_rng(6), weights()
    plain, adam = {k: v.astype(np.float64) for k, v in w.items()}, net.Adam(w, 1e-2)
    m, s = ({k: np.zeros(v.shape) for k, v in w.items()} for _ in range(2))
    for t in range(1, 6):
        g = {k: rng.normal(0, 1, w[k].shape).astype(np.float32) for k in reversed(net.SHAPES)}
        adam.step(w, g)
        for k in plain:
            m[k], s[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * s[k] + 0.001 * g[k].astype(np.float64) ** 2
            plain[k] -= 1e-2 * (1 - 0.999**t) ** 0.5 / (1 - 0.9**t) * m[k] / (np.sqrt(s[k]) + 1e-8)
    assert all(w[k] == pytest.approx(plain[k], abs=1e-4) for k in plain)


def test_training_learns_what_pairs_cannot_tell():
    """The slot two places back decides the next one."""
    rng = np.random.default_rng(5)
    slots = [net.OPENS, 1, 2]
    for _ in range(6000):
        slots.append((slots[-2] * 5 + 3) % 7 if rng.random() < 0.95 else int(rng.integers(7)))
        slots[-1:] = [slots[-1] + 40 * (slots[-1] % 3)] if slots[-1] < 7 else slots[-1:]
        slots[-1] %= 7
    stream, lengths = np.array(slots, np.int32), np.array([len(slots) - 1])
    pairs = np.zeros((net.SLOTS + 1, net.SLOTS))
    np.add.at(pairs, (stream[:-1], stream[1:]), 1)
    n = net.Net(net.first_weights(), net.counted_table(pairs))
    text, first, count = net.windows(lengths)
    adam, losses = net.Adam(n.w, 1e-2), []
    for _ in range(120):
        w = rng.integers(0, text.size, 64)
        seen, want = net.window_slots(stream, np.array([0]), text[w], first[w])
        loss, g = n.gradients(seen, first[w] == 0, np.arange(net.STEP)[None, :] < count[w][:, None], want)
        adam.step(n.w, g)
        n.refresh()
        losses.append(loss)
    assert np.mean(losses[-10:]) < 0.8 * losses[0]


DOCS = [
    (1, "The cat sat.  The\tcat\x0bsat", "x", 5.0),
    (2, None, "x", 5.0),
    (3, "", None, 5.0),
    (4, " \n ", "x", None),
    (None, "no id the cat", "x", 5.0),
    (None, "no id the cat", "x", 5.0),
    (6, "THE CAT Ää café   　 ​", "x", 5.0),
    (6, "another of the same id", "x", 5.0),
    (7, "word " * 30_000 + "x" * 5_000, "x", 5.0),
    *[(k, f"the cat {k % 7} sat on mat {k}", "x", 1.0) for k in range(10, 90)],
]
SCHEMA = "doc_id long, text string, held string, score double"


def held(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def scored(spark, docs, small: bool = False):
    rule = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    df = spark.createDataFrame(docs, SCHEMA).repartition(3) if docs else spark.createDataFrame([], SCHEMA)
    return lm.score(df, MODEL, rule).collect()


def test_base_counts_equal_plain_python(spark):
    counts = Counter()
    words = [((text or "").encode().lower().split()) for _, text, *_ in DOCS]
    for (doc_id, *_), own in zip(DOCS, words, strict=True):
        if not held(doc_id):
            counts.update([*own, "end"])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for (doc_id, *_), own in zip(DOCS, words, strict=True):
        tokens = [*own, "end"]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want[doc_id, held(doc_id), len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)] += 1
    rows = scored(spark, DOCS)
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    same = [r.score for r in rows if r.doc_id is None]
    assert same[0] == pytest.approx(same[1], rel=1e-5)
    empty = {round(r.score, 4) for r in rows if r.n_tokens == 1}
    assert len(empty) == 1  # null, empty and blank texts


def test_no_rows_and_nothing_to_learn_from(spark):
    assert scored(spark, []) == []
    only = [(k, "the cat", "x", 1.0) for k in range(200) if held(k)][:3]
    rows = scored(spark, only)
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 3
    assert all(math.isfinite(r.score) for r in rows)


def test_block_scores_equal_plain_loops():
    """Ids, slots and rare ids of a block's texts, against the library and the formulas."""
    import pyarrow as pa
    import sentencepiece

    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), *[(c, pa.binary()) for c in ("words", "names", "pieces", "piece_counts")]])
    texts = ["Un café the  end", "", "zzyx qwv the the", None]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "held": [False] * 4, "text": texts})
    block = lm.Texts(lm._block(batch, 0, lm.Pieces(MODEL), schema).to_pylist()[0])
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = [[i for w in (t or "").encode().lower().split() for i in library.encode(w.decode())] for t in texts]
    stream, lengths = block.stream(np.ones(4, bool))
    assert stream.tolist() == [i for own in ids for i in [-1, *own, lm.END_ID]] and lengths.tolist() == [len(own) + 1 for own in ids]
    counts = np.zeros(lm.IDS, np.int64)
    counts[[i for own in ids[:2] for i in own]] += 5
    counts[lm.END_ID] += 9
    slot, rest = lm.slots_of(counts)
    n = some_net()
    model = lm.Model(slot, rest, np.zeros((net.SLOTS + 1, net.SLOTS)), n.w)
    got = lm.log10_probs(block, model, n)
    for k, own in enumerate(ids):
        slots = [net.OPENS, *[int(slot[i]) for i in [*own, lm.END_ID]]]
        logs = [plain_log_prob(n, slots, t) for t in range(len(own) + 1)] + [rest[i] for i in own if slot[i] == lm.REST]
        assert got[k] == pytest.approx(sum(logs) / math.log(10), rel=1e-4)


def test_every_window_of_the_training_texts_trains():
    """Long and short texts, in and out of the held part: the count that the weights are averaged by is that of all windows."""
    import pyarrow as pa

    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), *[(c, pa.binary()) for c in ("words", "names", "pieces", "piece_counts")]])
    texts = ["the cat sat on the mat " * k for k in range(0, 400, 7)]
    held_out = [k % 3 == 0 for k in range(len(texts))]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "held": held_out, "text": texts})
    block = lm._block(batch, 0, lm.Pieces(MODEL), schema)
    one = lm.Texts(block.to_pylist()[0])
    _, lengths = one.stream(~one.held)
    slot, rest = lm.slots_of(np.zeros(lm.IDS, np.int64))
    model = lm.Model(slot, rest, np.zeros((net.SLOTS + 1, net.SLOTS)), net.first_weights())
    (out,) = lm._trained([block], model)
    got = dict(zip(out.column("key").to_pylist(), out.column("numbers").to_pylist(), strict=True))
    assert np.frombuffer(got[-1], "<f8").tolist() == [sum(-(-int(n) // net.STEP) for n in lengths)]
