"""Scores of the learnt operators (op1, op3, op10) against plain statements of their rules, text by text."""

import math
import re
import zlib

import numpy as np
import pytest
import zstandard

from feedlake.llm import langid, quality, toxicity

MULTIPLIER = 0x9E3779B1


def documents(spark, sf_dir, n=60):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang is not null").orderBy("doc_id").limit(n).collect()
    return [(r["lang"], r["text"]) for r in rows]


def gram_hash(part, n, bits):
    h = n
    for b in part:
        h = ((h ^ b) * MULTIPLIER) & 0xFFFFFFFF
    return h >> (32 - bits)


def naive_language(model, text):
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    raw = [b if b >= 128 or chr(b).isalpha() else 32 for b in (" " + text.lower() + " ").encode()]
    margins = []
    for j in range(len(model.pairs)):
        margin = float(model.bias[j])
        for g, n in enumerate(langid.GRAMS):
            grams = [raw[i:i + n] for i in range(len(raw) - n + 1)]
            margin += sum(float(model.weights[g][gram_hash(x, n, langid.DIM_BITS), j]) for x in grams) / max(1, len(grams)) * langid.SCALE
        margins.append(margin)

    def duel(level, classes):
        if len(classes) == 1:
            return classes[0], 1.0
        votes, sums, prob = ({c: 0.0 for c in classes} for _ in range(3))
        for (lv, a, b), m in zip(model.pairs, margins):
            if lv == level:
                p = 1 / (1 + math.exp(-max(-30, min(30, 2 * m))))
                for c, sign, q in ((a, 1, p), (b, -1, 1 - p)):
                    votes[c] += sign * m > 0
                    sums[c] += sign * m
                    prob[c] += q
        best = max(classes, key=lambda c: votes[c] + 0.49 * math.tanh(sums[c] / len(classes)))
        return best, prob[best] / (len(classes) - 1)

    family, sure = duel("", sorted(model.families))
    lang, p = duel(family, model.families[family])
    return lang, sure * p


def test_language_by_brute_force(spark, sf_dir):
    rows = documents(spark, sf_dir)
    model = langid.fit(rows)
    assert len(model.families) > 1 and any(level for level, _, _ in model.pairs)
    texts = [t[:400] for _, t in rows[::4]] + ["", "12 34", "é", "a", "Straße über Köln!", "ñandú 7 ²"]
    for text, (lang, score) in zip(texts, model.predict(texts)):
        want = naive_language(model, text)
        assert lang == want[0] and score == pytest.approx(want[1], abs=1e-4), text[:40]


def naive_toxicity(net, text):
    p, h = {k: v.astype(np.float64) for k, v in net.p.items()}, toxicity.HIDDEN
    words = re.findall(r"\w+", (text or "").lower())

    def vector(word):
        raw = b"^" + word.encode("utf-8", "replace") + b"$"
        grams = [gram_hash(raw[i:i + n], n, toxicity.GRAM_BITS) for n in toxicity.GRAMS for i in range(len(raw) - n + 1)]
        spelled = np.mean([p["gram"][g] for g in grams], axis=0) if grams else np.zeros(toxicity.DIM)
        return np.concatenate([p["word"][zlib.crc32(word.encode()) % (1 << toxicity.WORD_BITS)], spelled])

    def gru(inputs, u):
        state, out = np.zeros(h), []
        for a in inputs:
            b = state @ u
            z, r = 1 / (1 + np.exp(-(a[:h] + b[:h]))), 1 / (1 + np.exp(-(a[h:2 * h] + b[h:2 * h])))
            state = z * state + (1 - z) * np.tanh(a[2 * h:] + r * b[2 * h:])
            out.append(state)
        return out

    best = None
    for start in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE) if words else ():
        proj = [vector(w) @ p["x"] + p["xb"] for w in words[start:start + toxicity.WINDOW]]
        forth, back = gru([a[:3 * h] for a in proj], p["uf"]), gru([a[3 * h:] for a in proj[::-1]], p["ub"])[::-1]
        states = np.array([np.concatenate(x) for x in zip(forth, back)])
        weight = np.exp(states @ p["att"] - (states @ p["att"]).max())
        logit = (weight / weight.sum()) @ states @ p["out"] + p["bias"][0]
        best = logit if best is None else max(best, logit)
    return net.rate if best is None else 1 / (1 + math.exp(-(net.slope * best + net.shift)))


def test_toxicity_by_brute_force(spark, sf_dir):
    rows = [(i % 2, t + (" vile scum" if i % 2 else "")) for i, (_, t) in enumerate(documents(spark, sf_dir, 40))]
    net = toxicity.fit([(y, t[:600]) for y, t in rows], epochs=1)
    texts = [t[:900] for _, t in rows[::6]] + ["", None, "one", "!!", "ünï cödé scum " * 30]
    got = net.score(toxicity.Scorer(net).logits([t or "" for t in texts]))
    for text, score in zip(texts, got):
        assert score == pytest.approx(naive_toxicity(net, text), abs=2e-3), (text or "")[:40]


def test_long_texts_train_on_their_worst_windows():
    starts = np.array(range(0, 2400, 24))
    logits = np.zeros(len(starts))
    logits[[7, 50, 93]] = 5
    picked = toxicity.chosen_windows(starts, logits, np.random.default_rng(0))
    assert len(set(picked.tolist())) == len(picked) == toxicity.FIT_WINDOWS and {7 * 24, 50 * 24, 93 * 24} <= set(picked.tolist())


def naive_quality(model, text):
    def size(content, part):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=d, level=quality.LEVEL, write_content_size=False, write_dict_id=False).compress(part))

    raw = (text or "").encode()
    total = 0.0
    for i in range(0, len(raw), quality.WINDOW):
        part = raw[i:i + quality.WINDOW]
        total += max(-quality.CLIP * len(part), min(quality.CLIP * len(part), size(model.bad, part) - size(model.good, part)))
    return 1 / (1 + math.exp(-max(-30, min(30, model.weight * (total / len(raw) if raw else 0.0) + model.bias))))


def test_quality_by_brute_force(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [(labels[r["doc_id"]], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect() if labels.get(r["doc_id"]) in (0, 1)]
    model = quality.fit(rows)
    pair = model.compressors()
    texts = [t[:700] for _, t in rows[::40]] + ["", None, "x", "é" * 300]
    for text in texts:
        assert model.score([quality.difference(text, *pair)])[0] == pytest.approx(naive_quality(model, text), abs=1e-9), (text or "")[:40]
