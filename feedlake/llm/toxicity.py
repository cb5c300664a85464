"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A text is a sequence of lower-cased words.  A word's input joins two vectors: an
embedding of the word itself (hashed) and the mean embedding of its character
n-grams (hashed, with word boundaries), so unseen forms of a known stem are read
by their characters.  A forward and a backward gated recurrent layer run over
each window of ``WINDOW`` words; attention pools the states; a linear layer gives
the window's logit.  A text's windows overlap by half and all of them are
scored; the largest logit, calibrated, is the text's score.

Everything is numpy.  Training takes a bounded sample: a document's logit is the
log-sum-exp of its windows' logits, so that a toxic document need only have one
toxic window, and the gradients run back through time to the embeddings.  Scoring
computes a word's input projection once per worker and word and advances
thousands of windows a step at a time.

Defined cases: null and empty texts, and texts without a word, get the share of
label 1 as their score; a short text is one window; repeated rows get equal
scores; with labels of one class only every score is that class's smoothed share.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, labelled_sample, map_texts

WINDOW, STRIDE = 48, 24
HIDDEN, DIM = 8, 12
WORD_BITS, GRAM_BITS = 13, 14
GRAMS = (3, 4, 5)
#: Bounds of the sample that is fitted on: rows of each class, windows of a row and epoch.
FIT_ROWS, FIT_WINDOWS = {0: 2400, 1: 1200}, 10
EPOCHS = 5
#: Epochs before which all windows of the longer texts are scored anew.
HARD_EPOCHS = (1, 3)
#: Words whose input projections a worker keeps.
CACHE_WORDS = 200_000
_BATCH_WINDOWS = 2048

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def window_starts(n: int) -> range:
    """Starts of the overlapping windows over n words; the last one reaches the end."""
    return range(0, max(1, n - WINDOW + STRIDE), STRIDE)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def gram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code, word number) of every character n-gram, ordered by word within each n."""
    raw = [b"^" + w.encode("utf-8", "replace") + b"$" for w in words]
    a = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    codes, owners = [], []
    for n in GRAMS:
        if len(a) < n:
            continue
        h = np.full(len(a) - n + 1, n, dtype=np.uint32)
        for i in range(n):
            h = (h ^ a[i:len(a) - n + 1 + i]) * np.uint32(0x9E3779B1)
        whole = owner[:len(a) - n + 1] == owner[n - 1:]
        codes.append((h[whole] >> np.uint32(32 - GRAM_BITS)).astype(np.int64))
        owners.append(owner[:len(a) - n + 1][whole])
    if not codes:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(codes), np.concatenate(owners)


def word_codes(words: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(w.encode("utf-8", "replace")) & ((1 << WORD_BITS) - 1) for w in words], dtype=np.int64)


@dataclass
class Net:
    """Parameters by name; ``x`` projects inputs for both directions: (update, reset, candidate) twice."""

    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    rate: float = 0.5

    @property
    def blank(self) -> float:
        """The logit that calibrates to the share of label 1."""
        return (float(np.log(self.rate / (1 - self.rate))) - self.shift) / self.slope if self.slope else 0.0

    @classmethod
    def new(cls, seed: int = 3) -> Net:
        rng = np.random.default_rng(seed)

        def draw(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        h = HIDDEN
        return cls({
            # small, so that what training has not seen says little
            "word": draw(1 << WORD_BITS, DIM, scale=0.03), "gram": draw(1 << GRAM_BITS, DIM, scale=0.03),
            "x": draw(2 * DIM, 6 * h, scale=(2 * DIM) ** -0.5), "xb": np.zeros(6 * h, dtype=np.float32),
            "uf": draw(h, 3 * h, scale=h ** -0.5), "ub": draw(h, 3 * h, scale=h ** -0.5),
            "att": draw(2 * h, scale=0.3), "out": draw(2 * h, scale=0.3), "bias": np.zeros(1, dtype=np.float32)})

    def inputs(self, words: list[str], keep: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
        """Input vectors of words; ``keep`` masks word embeddings out during training."""
        wc = word_codes(words)
        gc, owner = gram_codes(words)
        n = np.maximum(np.bincount(owner, minlength=len(words)), 1).astype(np.float32)
        grams = np.zeros((len(words), DIM), dtype=np.float32)
        for d in range(DIM):
            grams[:, d] = np.bincount(owner, weights=self.p["gram"][gc, d], minlength=len(words)) / n
        own = self.p["word"][wc]
        if keep is not None:
            own = own * keep[:, None]
        return np.concatenate([own, grams], axis=1), (wc, gc, owner, n)

    def run(self, proj: np.ndarray, u: np.ndarray, mask: np.ndarray, order, trace: list | None = None) -> np.ndarray:
        """States of one direction, shape (T, B, H): proj is (T, B, 3H), mask (T, B)."""
        h = HIDDEN
        state = np.zeros((proj.shape[1], h), dtype=np.float32)
        out = np.zeros((proj.shape[0], proj.shape[1], h), dtype=np.float32)
        for t in order:
            a = proj[t]
            b = state @ u
            zr = sigmoid(a[:, :2 * h] + b[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(a[:, 2 * h:] + r * b[:, 2 * h:])
            m = mask[t][:, None]
            new = state + m * (1 - z) * (n - state)
            if trace is not None:
                trace.append((t, state, z, r, n, b[:, 2 * h:], m))
            state = new
            out[t] = state
        return out

    def forward(self, proj: np.ndarray, mask: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logits of windows: proj (T, B, 6H), mask (T, B)."""
        h, steps = HIDDEN, range(proj.shape[0])
        tf, tb = ([], []) if trace is not None else (None, None)
        states = np.concatenate([self.run(proj[:, :, :3 * h], self.p["uf"], mask, steps, tf),
                                 self.run(proj[:, :, 3 * h:], self.p["ub"], mask, steps[::-1], tb)], axis=2)
        score = np.where(mask > 0, states @ self.p["att"], -1e9)
        weight = np.exp(score - score.max(axis=0)) * mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        if trace is not None:
            trace.update(tf=tf, tb=tb, states=states, weight=weight, pooled=pooled)
        return pooled @ self.p["out"] + self.p["bias"][0]

    def backward(self, dlogit: np.ndarray, mask: np.ndarray, trace: dict, grads: dict) -> np.ndarray:
        """Adds parameter gradients to ``grads`` and returns the gradient of proj."""
        h = HIDDEN
        states, weight, pooled = trace["states"], trace["weight"], trace["pooled"]
        grads["out"] += dlogit @ pooled
        grads["bias"] += dlogit.sum()
        dpool = dlogit[:, None] * self.p["out"]
        dweight = (states * dpool).sum(axis=2)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0))
        grads["att"] += np.einsum("tb,tbh->h", dscore, states)
        dstates = weight[:, :, None] * dpool + dscore[:, :, None] * self.p["att"]
        dproj = np.zeros((*mask.shape, 6 * h), dtype=np.float32)
        for name, steps, at in (("uf", trace["tf"], 0), ("ub", trace["tb"], 1)):
            u = self.p[name]
            carry = np.zeros_like(pooled[:, :h])
            for t, prev, z, r, n, bn, m in reversed(steps):
                d = carry + dstates[t, :, at * h:(at + 1) * h]
                dn = d * m * (1 - z) * (1 - n * n)
                dz = -d * m * (n - prev) * z * (1 - z)
                dr = dn * bn * r * (1 - r)
                da = np.concatenate([dz, dr, dn], axis=1)
                db = np.concatenate([dz, dr, dn * r], axis=1)
                dproj[t, :, 3 * h * at:3 * h * (at + 1)] = da
                grads[name] += prev.T @ db
                carry = d * (1 - m * (1 - z)) + db @ u.T
        return dproj

    def score(self, logits) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(logits, dtype=np.float64) + self.shift, -30, 30)))


def lay_out(ids: np.ndarray, starts: list[tuple[int, int]], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(T, B) word numbers and mask of windows given as (start, end) in ``ids``."""
    lengths = np.array([e - s for s, e in starts])
    at = np.array([s for s, _ in starts])[None, :] + np.arange(max(1, lengths.max(initial=1)))[:, None]
    mask = np.arange(at.shape[0])[:, None] < lengths[None, :]
    if len(ids) == 0:
        return np.full(at.shape, pad), mask.astype(np.float32)
    return np.where(mask, ids[np.minimum(at, len(ids) - 1)], pad), mask.astype(np.float32)


class Scorer:
    """Scores texts, keeping the projections of words already seen."""

    def __init__(self, net: Net):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.table = np.zeros((1, 6 * HIDDEN), dtype=np.float32)

    def ids(self, words: list[str]) -> np.ndarray:
        number = self.number
        new = list(dict.fromkeys(w for w in words if w not in number))
        if new:
            blocks = []
            for i in range(0, len(new), 20000):
                x, _ = self.net.inputs(new[i:i + 20000])
                blocks.append(x @ self.net.p["x"] + self.net.p["xb"])
            for w in new:
                number[w] = len(number)
            self.table = np.concatenate([self.table, *blocks])
        return np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))

    def windows(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(owner, logit) of all windows of the documents' words."""
        if len(self.number) > CACHE_WORDS:
            self.clear()
        words, spans, owner = [], [], []
        for i, own in enumerate(docs):
            base, n = len(words), len(own)
            words += own
            for s in window_starts(n) if n else ():
                spans.append((base + s, base + min(n, s + WINDOW)))
                owner.append(i)
        ids = self.ids(words)
        z = np.zeros(len(spans))
        order = sorted(range(len(spans)), key=lambda j: spans[j][1] - spans[j][0])  # windows of like length together
        for i in range(0, len(order), _BATCH_WINDOWS):
            part = order[i:i + _BATCH_WINDOWS]
            at, mask = lay_out(ids, [spans[j] for j in part], 0)
            z[part] = self.net.forward(self.table[at], mask)
        return np.array(owner, dtype=np.int64), z

    def logits(self, texts: list[str]) -> np.ndarray:
        """The largest window logit of each text."""
        owner, z = self.windows([words_of(t) for t in texts])
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, z)
        return np.where(np.isneginf(best), self.net.blank, best)


def fit(rows: list[tuple[int, str]], rate: float | None = None, epochs: int = EPOCHS, seed: int = 11) -> Net:
    """``rows``: (label, text); ``rate``: the share of label 1 among all labels if the rows are a sample by class."""
    rng = np.random.default_rng(seed)
    y = np.array([int(r[0]) for r in rows], dtype=np.float32)
    if rate is None:
        rate = float(y.mean()) if len(y) else 0.5
    net = Net.new(seed)
    net.rate = min(max(rate, 1e-3), 1 - 1e-3)
    if len(set(y.tolist())) < 2:
        share = min(max((y.sum() + 0.5) / (len(y) + 1), 1e-3), 1 - 1e-3)
        net.slope, net.shift, net.rate = 0.0, float(np.log(share / (1 - share))), float(share)
        return net
    docs = [words_of(t) for _, t in rows]
    held = rng.random(len(rows)) < 0.15
    train_rows = np.nonzero(~held)[0]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    hardest: dict[int, np.ndarray] = {}
    for epoch in range(epochs):
        # What the net finds most suspicious so far, in every window of the longer texts.
        hardest = window_logits(net, {i: docs[i] for i in train_rows if len(window_starts(len(docs[i]))) > FIT_WINDOWS}) if epoch in HARD_EPOCHS else hardest
        for part in np.array_split(rng.permutation(train_rows), max(1, len(train_rows) // 32)):
            spans, owner, words = [], [], []
            for j, i in enumerate(part):
                starts = np.array(window_starts(len(docs[i])))
                if len(starts) > FIT_WINDOWS:
                    starts = chosen_windows(starts, hardest.get(i), rng)
                for s in starts:
                    own = docs[i][s:s + WINDOW]
                    spans.append((len(words), len(words) + len(own)))
                    owner.append(j)
                    words += own
            owner = np.array(owner)
            names = {w: k for k, w in enumerate(dict.fromkeys(words), 1)}
            distinct = ["", *names]
            ids = np.array([names[w] for w in words], dtype=np.int64)
            at, mask = lay_out(ids, spans, 0)
            x, (wc, gc, gram_owner, n) = net.inputs(distinct, (rng.random(len(distinct)) > 0.3).astype(np.float32))
            trace: dict = {}
            z = net.forward((x @ net.p["x"] + net.p["xb"])[at], mask, trace)
            top = np.full(len(part), -np.inf, dtype=np.float32)
            np.maximum.at(top, owner, z)
            e = np.exp(z - top[owner])
            total = np.bincount(owner, weights=e, minlength=len(part))
            doc = top + np.log(total)
            err = (sigmoid(doc) - y[part]) / len(part)
            grads = {k: np.zeros_like(v) for k, v in net.p.items()}
            dproj = net.backward((err[owner] * e / total[owner]).astype(np.float32), mask, trace, grads)
            flat = dproj.reshape(-1, dproj.shape[2])
            dword = np.zeros((len(distinct), flat.shape[1]), dtype=np.float32)
            for d in range(flat.shape[1]):
                dword[:, d] = np.bincount(at.reshape(-1), weights=flat[:, d], minlength=len(distinct))
            dword[0] = 0
            grads["x"] += x.T @ dword
            grads["xb"] += dword.sum(axis=0)
            dx = dword @ net.p["x"].T
            np.add.at(grads["word"], wc, dx[:, :DIM])
            dg = dx[:, DIM:] / n[:, None]
            for d in range(DIM):
                grads["gram"][:, d] += np.bincount(gc, weights=dg[gram_owner, d], minlength=1 << GRAM_BITS)
            step += 1
            rate_now = 0.01 * (1 - step / (epochs * max(1, len(train_rows) // 32) + 1))
            for k, v in net.p.items():  # Adam
                g, (m, s) = grads[k], moments[k]
                np.clip(g, -1, 1, out=g)
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                v -= rate_now * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    calibrate(net, [rows[i] for i in (np.nonzero(held)[0] if 0 < y[held].sum() < held.sum() else range(len(rows)))], net.rate)
    return net


def window_logits(net: Net, docs: dict[int, list[str]], words: int = 200_000) -> dict[int, np.ndarray]:
    """Logits of all windows of each text, some ``words`` at a time."""
    scorer, found, group, size = Scorer(net), {}, [], 0
    for k, (i, own) in enumerate(docs.items(), 1):
        group.append(i)
        size += len(own)
        if size >= words or k == len(docs):
            owner, z = scorer.windows([docs[j] for j in group])
            for n, j in enumerate(group):
                found[j] = z[owner == n]
            group, size = [], 0
    return found


def chosen_windows(starts: np.ndarray, logits: np.ndarray | None, rng: np.random.Generator) -> np.ndarray:
    """FIT_WINDOWS of a text's windows for one step: half of them those of the largest logits, the others random ones of the rest."""
    order = rng.permutation(len(starts)) if logits is None else np.argsort(-logits, kind="stable")
    top, rest = order[:FIT_WINDOWS // 2], order[FIT_WINDOWS // 2:]
    return starts[np.concatenate([top, rng.choice(rest, FIT_WINDOWS - len(top), replace=False)])]


def calibrate(net: Net, rows: list[tuple[int, str]], rate: float) -> None:
    """Logistic regression of the labels on the largest window logits, weighted to the true share of label 1."""
    x = Scorer(net).logits([t or "" for _, t in rows])
    y = np.array([int(r[0]) for r in rows], dtype=np.float64)
    w = np.where(y == 1, rate / max(1, y.sum()), (1 - rate) / max(1, (1 - y).sum()))
    y = np.where(y == 1, 1 - 1 / (y.sum() + 2), 1 / ((1 - y).sum() + 2))  # smoothed targets keep the slope finite
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(w * (p - y) * x).sum() + 1e-4 * (a - 1), (w * (p - y)).sum() + 1e-6 * b])
        r = w * p * (1 - p)
        step = np.linalg.solve([[(r * x * x).sum() + 1e-4, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-6]], g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    net.slope, net.shift = float(max(a, 1e-2)), float(b)


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, rows_per_class: dict[int, int] | int = FIT_ROWS) -> Net:
    """Fit on at most ``rows_per_class`` labelled rows of each class outside the held-out fold."""
    away = fold(F.col("doc_id"), folds) == held_out
    rate = labels.where(~away).where("doc_id is not null").agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    sample = labelled_sample(docs, labels, "toxic", rows_per_class, held_out=away)
    rows = sample.select("doc_id", "y", "text").collect()
    return fit([(r["y"], r["text"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["y"], r["text"] or ""))], rate)


def score_toxicity(docs: DataFrame, net: Net, column: str = "toxicity") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each row's whole text (a column of that name is replaced)."""
    def start():
        scorer = Scorer(net)
        return lambda texts: [net.score(scorer.logits(texts)).tolist()]

    return map_texts(docs, "text", {column: "double"}, start)
