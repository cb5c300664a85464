"""Toxicity network: gradients, held-out accuracy, defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import toxicity
from feedlake.llm.common import fold

DIR = "/root/testdata/sf0.1"


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Net.new(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    steps, batch = 5, 4
    proj = rng.standard_normal((steps, batch, 6 * toxicity.HIDDEN))
    mask = (np.arange(steps)[:, None] < np.array([5, 3, 1, 0])[None]).astype(float)
    weight = rng.standard_normal(batch)
    trace, grads = {}, {k: np.zeros_like(v) for k, v in net.p.items()}
    net.forward(proj, mask, trace)
    dproj = net.backward(weight, mask, trace, grads)

    def loss():
        return net.forward(proj, mask) @ weight

    for name, target, grad in [*((k, net.p[k], grads[k]) for k in ("uf", "ub", "att", "out", "bias")), ("proj", proj, dproj)]:
        for _ in range(6):
            i = tuple(rng.integers(s) for s in target.shape)
            old = target[i]
            target[i] = old + 1e-4
            up = loss()
            target[i] = old - 1e-4
            down = loss()
            target[i] = old
            # states are kept in single precision
            assert (up - down) / 2e-4 == pytest.approx(grad[i], abs=3e-3), name


def test_windows_overlap_and_cover():
    for n in (0, 1, 47, 48, 49, 72, 73, 500):
        starts = list(toxicity.window_starts(n))
        covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n)) and starts[0] == 0
        assert all(b - a == toxicity.STRIDE < toxicity.WINDOW for a, b in zip(starts, starts[1:]))


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    net = toxicity.train(docs, labels, rows_per_class={0: 1600, 1: 800})
    away = labels.where(fold(F.col("doc_id"), 5) == 0).select("doc_id", "toxic")
    got = toxicity.score_toxicity(docs.select("doc_id", "text").join(away.select("doc_id"), "doc_id", "left_semi"), net).join(away, "doc_id").toPandas()
    s, y = got["toxicity"].to_numpy(), got["toxic"].to_numpy()
    assert ((s >= 0.5) == y).mean() > 0.96
    assert (s[y == 1] >= 0.5).mean() > 0.85


def test_one_toxic_window_in_a_long_text():
    filler = "calm words are here and more calm there ".split() * 8
    rows = [(0, " ".join(filler))] * 36
    for i in range(36):
        at = 1 + i % 40
        rows.append((1, " ".join([*filler[:at], ("scumbag", "idiotic", "moronic")[i % 3], *filler[at:]])))
    net = toxicity.fit(rows, epochs=60)
    scorer = toxicity.Scorer(net)
    calm = "calm words are here and more calm there " * 4000
    a, b = net.score(scorer.logits([calm, calm + "idiotic " + calm]))
    assert a < 0.5 < b


def test_defined_cases(spark):
    net = toxicity.fit([(0, "a"), (0, "b")])
    df = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "!!", 1.0), (3, "!!", 1.0)], "doc_id long, text string, score double")
    assert {round(r["toxicity"], 6) for r in toxicity.score_toxicity(df, net).collect()} == {round(0.5 / 3, 6)}
    net = toxicity.fit([(0, "nice day"), (1, "you scum")] * 10, rate=0.2, epochs=1)
    assert {round(r["toxicity"], 6) for r in toxicity.score_toxicity(df, net).collect()} == {0.2}
    empty = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.score_toxicity(empty, toxicity.train(empty, labels)).collect() == []
