"""A small causal self-attention model in numpy: one layer, class-factored output, trained with Adam.

Slots 0 to K - 1 are the most frequent ids, slot K - 1 all others; slot K opens a text. The probability of the next slot is
that of its class times that within the class. Both start from counts of neighbouring slots (a table of log probabilities),
to which attention over the window adds what the rest of the window tells.
"""

from __future__ import annotations

import numpy as np

CLASSES = 32
WITHIN = 32
SLOTS = CLASSES * WITHIN
OPENS = SLOTS  # the slot before the first token of a text
STEP = 16  # positions a window scores
BEFORE = 8  # positions that it only looks at
WIDTH = BEFORE + STEP
DIM, KEY, HIDDEN = 16, 8, 32
NEVER = np.float32(-1e4)
SHARPEST = np.float32(60.0)  # exponents within this need no care in single precision

#: Names and shapes of what is trained.
SHAPES = {
    "embed": (SLOTS + 1, DIM),
    "query": (DIM, KEY),
    "key": (DIM, KEY),
    "value": (DIM, DIM),
    "distance": (WIDTH,),
    "mix_own": (DIM, HIDDEN),
    "mix_seen": (DIM, HIDDEN),
    "mix_bias": (HIDDEN,),
    "mix_out": (HIDDEN, DIM),
    "classes": (DIM, CLASSES),
    "within": (CLASSES, DIM, WITHIN),
}


def first_weights(seed: int = 1) -> dict[str, np.ndarray]:
    """Where training starts: the counted table decides alone, as both output layers are zero."""
    rng = np.random.default_rng(seed)
    out = {}
    for name, shape in SHAPES.items():
        fan = shape[-2] if len(shape) > 1 else 1
        out[name] = (rng.normal(0, 0.3 if name == "embed" else fan**-0.5, shape)).astype(np.float32)
    for name in ("distance", "mix_bias", "classes", "within"):
        out[name][:] = 0
    return out


def counted_table(pairs: np.ndarray, weight: float = 8.0) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of class and of slot within class after each slot, from counts of (slot before, slot).

    Counts after one slot are filled up with ``weight`` rows of the counts after all slots.
    """
    whole = pairs.sum(0) + 0.5
    shares = (pairs + weight * (whole / whole.sum())).reshape(SLOTS + 1, CLASSES, WITHIN)
    classes = shares.sum(2)
    within = np.log(shares / classes[:, :, None]).astype(np.float32)
    return np.log(classes / classes.sum(1, keepdims=True)).astype(np.float32), within


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over texts of ``lengths`` scored positions laid end to end: text, first scored position in it, positions scored.

    Every position is scored in exactly one window; a window also looks at the ``BEFORE`` positions before it.
    """
    each = -(-lengths // STEP)
    text = np.repeat(np.arange(lengths.size), each)
    first = (np.arange(text.size) - np.repeat(np.cumsum(each) - each, each)) * STEP
    return text, first, np.minimum(lengths[text] - first, STEP)


class Net:
    def __init__(self, weights: dict[str, np.ndarray], table: tuple[np.ndarray, np.ndarray]):
        self.w, self.class_table, self.within_table = weights, *table
        back = np.arange(BEFORE, WIDTH)[:, None] - np.arange(WIDTH)[None, :]
        self.back = np.maximum(back, 0)
        self.future = back < 0
        self.refresh()

    def refresh(self) -> None:
        """What every slot contributes, once for all its occurrences."""
        w = self.w
        self.q = w["embed"] @ w["query"] * np.float32(KEY**-0.5)
        self.k = w["embed"] @ w["key"]
        self.v = w["embed"] @ w["value"]
        self.own = w["embed"] @ w["mix_own"] + w["mix_bias"]
        self.bias = np.where(self.future, NEVER, w["distance"][self.back]).astype(np.float32)
        self.bias_first = self.bias.copy()
        self.bias_first[:, :BEFORE] = NEVER
        self.v_one = np.hstack([self.v, np.ones((len(self.v), 1), np.float32)])  # its last column sums the weights
        self.widest = max(np.abs(w["classes"]).sum(0).max(), np.abs(w["within"]).sum(1).max())
        most = np.sqrt(np.square(self.q).sum(1).max() * np.square(self.k).sum(1).max()) + np.abs(w["distance"]).max()
        self.sharp = not most <= SHARPEST  # else no exponent of attention can leave the range

    def hidden(self, seen: np.ndarray, opening: np.ndarray, keep: bool = False):
        """State after each scored position; with ``keep`` also what the gradients need. ``seen``: (windows, WIDTH) slots, ``opening``: windows without positions before them."""
        flat = seen[:, BEFORE:].ravel()
        q = self.q.take(flat, axis=0).reshape(len(seen), STEP, KEY)
        k = self.k.take(seen.ravel(), axis=0).reshape(len(seen), WIDTH, KEY)
        v = self.v_one.take(seen.ravel(), axis=0).reshape(len(seen), WIDTH, DIM + 1)
        score = np.matmul(q, k.transpose(0, 2, 1))
        score += self.bias
        if opening.any():
            score[opening] += self.bias_first - self.bias
        if self.sharp:
            score -= score.max(2, keepdims=True)
        np.exp(score, out=score)
        heard = np.matmul(score, v)
        total = heard[:, :, DIM:]
        heard = (heard[:, :, :DIM] / total).reshape(-1, DIM)
        mixed = heard @ self.w["mix_seen"]
        mixed += self.own.take(flat, axis=0)
        np.maximum(mixed, 0, out=mixed)
        state = mixed @ self.w["mix_out"]
        state += heard
        state += self.w["embed"].take(flat, axis=0)
        if not keep:
            return state
        score /= total
        return state, score, heard, mixed, q, k, v[:, :, :DIM]

    def log_probs(self, state: np.ndarray, last: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each ``target`` slot after ``last``, given the state."""
        group = target // WITHIN
        order = np.argsort(group.astype(np.uint8), kind="stable")
        cuts = np.searchsorted(group[order], np.arange(CLASSES + 1))
        state, last, group, place = state.take(order, axis=0), last[order], group[order], target[order] % WITHIN
        sharp = not np.abs(state).max(initial=0) * self.widest <= SHARPEST  # else no exponent can leave the range
        logits = state @ self.w["classes"]
        logits += self.class_table.take(last, axis=0)
        out = _log_share(logits, group, sharp)
        logits = self.within_table.reshape(-1, WITHIN).take(last * CLASSES + group, axis=0)
        for c in range(CLASSES):
            if cuts[c] < cuts[c + 1]:
                logits[cuts[c] : cuts[c + 1]] += state[cuts[c] : cuts[c + 1]] @ self.w["within"][c]
        out += _log_share(logits, place, sharp)
        back = np.empty_like(out)
        back[order] = out
        return back

    def gradients(self, seen: np.ndarray, opening: np.ndarray, valid: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log probability of the valid positions, and its gradients."""
        w, n = self.w, max(int(valid.sum()), 1)
        state, share, heard, mixed, q, k, v = self.hidden(seen, opening, keep=True)
        last, want = seen[:, BEFORE:].ravel(), target.ravel()
        at = np.flatnonzero(valid.ravel())
        group = want.take(at) // WITHIN
        g = {name: np.zeros(SHAPES[name], np.float32) for name in ("embed", "within")}
        order = np.argsort(group.astype(np.uint8), kind="stable")
        at, group = at.take(order), group.take(order)
        s, prev, place = state.take(at, axis=0), last.take(at), want.take(at) % WITHIN
        sharp = not np.abs(s).max(initial=0) * self.widest <= SHARPEST  # else no exponent can leave the range
        cuts = np.searchsorted(group, np.arange(CLASSES + 1))
        p = s @ w["classes"]
        p += self.class_table.take(prev, axis=0)
        loss = _off_target(p, group, n, sharp)
        g["classes"] = s.T @ p
        ds = p @ w["classes"].T
        p = self.within_table.reshape(-1, WITHIN).take(prev * CLASSES + group, axis=0)
        for c in np.flatnonzero(np.diff(cuts)):
            p[cuts[c] : cuts[c + 1]] += s[cuts[c] : cuts[c + 1]] @ w["within"][c]
        loss += _off_target(p, place, n, sharp)
        for c in np.flatnonzero(np.diff(cuts)):
            rows = slice(cuts[c], cuts[c + 1])
            g["within"][c] = s[rows].T @ p[rows]
            ds[rows] += p[rows] @ w["within"][c].T
        d = np.zeros_like(state)
        d[at] = ds
        d_mixed = d @ w["mix_out"].T
        d_mixed *= mixed > 0
        e_own, e_seen = w["embed"].take(last, axis=0), w["embed"].take(seen.ravel(), axis=0)
        g["mix_out"] = mixed.T @ d
        g["mix_bias"] = d_mixed.sum(0)
        g["mix_own"] = e_own.T @ d_mixed
        g["mix_seen"] = heard.T @ d_mixed
        d_embed_own = d_mixed @ w["mix_own"].T
        d_embed_own += d
        d_heard = d_mixed @ w["mix_seen"].T
        d_heard += d
        d_heard = d_heard.reshape(len(seen), STEP, DIM)
        d_score = np.matmul(d_heard, v.transpose(0, 2, 1))
        d_v = np.matmul(share.transpose(0, 2, 1), d_heard)
        d_score -= (share * d_score).sum(2, keepdims=True)
        d_score *= share
        g["distance"] = np.bincount(self.back[~self.future], d_score.sum(0)[~self.future], WIDTH).astype(np.float32)
        d_q = np.matmul(d_score, k).reshape(-1, KEY)
        d_q *= np.float32(KEY**-0.5)
        d_k = np.matmul(d_score.transpose(0, 2, 1), q).reshape(-1, KEY)
        d_v = d_v.reshape(-1, DIM)
        g["query"] = e_own.T @ d_q
        g["key"] = e_seen.T @ d_k
        g["value"] = e_seen.T @ d_v
        d_embed_own += d_q @ w["query"].T
        add_rows(g["embed"], last, d_embed_own)
        d_embed_seen = d_k @ w["key"].T
        d_embed_seen += d_v @ w["value"].T
        add_rows(g["embed"], seen.ravel(), d_embed_seen)
        return float(loss) / n, g


def _log_share(logits: np.ndarray, chosen: np.ndarray, sharp: bool) -> np.ndarray:
    if sharp:
        logits -= logits.max(1, keepdims=True)
    picked = logits.ravel().take(np.arange(chosen.size) * logits.shape[1] + chosen)
    return picked - np.log(np.exp(logits, out=logits) @ np.ones(logits.shape[1], np.float32))


def _off_target(logits: np.ndarray, chosen: np.ndarray, n: int, sharp: bool) -> float:
    """Logits to the gradient of the mean negative log share, in place; the sum of the negative logs."""
    if sharp:
        logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], np.float32)
    flat, picked = logits.reshape(-1), np.arange(chosen.size) * logits.shape[1] + chosen
    loss = -float(np.log(np.maximum(flat.take(picked) / total, 1e-30)).sum())
    logits *= (1 / (total * np.float32(n)))[:, None]
    flat[picked] -= np.float32(1 / n)
    return loss


def add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(at.astype(np.uint16), kind="stable")  # a radix sort
    ordered = at[order]
    begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out[ordered[begin]] += np.add.reduceat(rows.take(order, axis=0), begin, axis=0)


class Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m, self.s = (np.zeros(sum(v.size for v in weights.values()), np.float32) for _ in range(2))

    def step(self, weights: dict[str, np.ndarray], g: dict[str, np.ndarray], rate: float | None = None) -> None:
        """All weights move at once, as one list of numbers."""
        self.t += 1
        pace = (rate or self.rate) * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        flat = np.concatenate([g[k].ravel() for k in weights])
        self.m += 0.1 * (flat - self.m)
        self.s += 0.001 * (flat**2 - self.s)
        change, at = np.float32(pace) * self.m / (np.sqrt(self.s) + 1e-8), 0
        for v in weights.values():
            v -= change[at : at + v.size].reshape(v.shape)
            at += v.size


def window_slots(slots: np.ndarray, begin: np.ndarray, text: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What windows see and are to predict. ``slots``: texts end to end, each opened by ``OPENS`` and closed by its end; ``begin``: where each opens."""
    at = (begin[text] + first)[:, None] - BEFORE + np.arange(WIDTH + 1)[None, :]
    seen = slots[np.clip(at, 0, slots.size - 1)]
    return seen[:, :WIDTH], seen[:, BEFORE + 1 :]
