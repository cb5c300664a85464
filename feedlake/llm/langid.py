"""Language identification in two levels.

Level 1 predicts the language family, level 2 the language within it.  Both
levels decide between classes with one-versus-one linear support vector
machines; level 2 only has machines for pairs of languages of one family, so
closely related languages get machines of their own and distant ones are never
compared directly.

Features are relative frequencies of hashed byte bigrams, trigrams and
quadrigrams of the lower-cased text, in which everything but letters is a
space.  A linear score is then the mean of one weight per n-gram, which numpy
computes for whole batches by table lookup.

Defined cases: ``und`` (score 0) for null or empty text or text without a
letter; repeated rows get equal predictions; a tie of votes goes to the larger
sum of margins, then to the language first in alphabetical order; languages
without an entry in ``FAMILIES`` form the family ``other``; without labelled
rows every text is ``und``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, map_texts, sample_by_hash

#: Families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nl", "nb", "nn", "no", "sv", "yi"),
    "romance": ("an", "ast", "ca", "co", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro", "sc"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indic": ("as", "bn", "gu", "hi", "mr", "ne", "or", "pa", "sa", "si", "ur"),
    "turkic": ("az", "ba", "kk", "ky", "tk", "tr", "tt", "ug", "uz"),
    "uralic": ("et", "fi", "hu", "se"),
    "semitic": ("am", "ar", "he", "mt", "ti"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "sinitic": ("yue", "zh"),
}
UNKNOWN = "und"
DIM_BITS = 13
GRAMS = (2, 3, 4)
#: Bounds of the sample that is fitted on.
FIT_ROWS_PER_LANG = 400
FIT_LANGUAGES = 64

#: Byte table: ASCII letters and all bytes of multi-byte characters stay, the rest is a space.
_TABLE = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint8)
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter (word characters like ``²`` are not)."""
    m = _LETTER.search(text)
    return m is not None and (m.group().isalpha() or any(map(str.isalpha, text)))


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), "other")


def codes(raw: np.ndarray) -> list[np.ndarray]:
    """Hashed n-gram numbers at each position, one array for each length in GRAMS."""
    a = _TABLE[raw].astype(np.uint32)
    out = []
    for n in GRAMS:
        if len(a) < n:
            out.append(np.zeros(0, dtype=np.int32))
            continue
        h = np.full(len(a) - n + 1, n, dtype=np.uint32)
        for i in range(n):
            h = (h ^ a[i:len(a) - n + 1 + i]) * np.uint32(0x9E3779B1)
        out.append((h >> np.uint32(32 - DIM_BITS)).astype(np.int32))
    return out


def _bytes(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace") + b" "


def features(text: str) -> np.ndarray:
    """Relative n-gram frequencies, each length in its own part of the vector."""
    parts = []
    for c in codes(np.frombuffer(_bytes(text), dtype=np.uint8)):
        parts.append(np.bincount(c, minlength=1 << DIM_BITS) / max(1, len(c)))
    return (np.concatenate(parts) * SCALE).astype(np.float32)


#: Brings frequencies to a size at which unit regularisation suits the machines.
SCALE = 30.0


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 12, seed: int = 5) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by dual coordinate descent; y is +1 or -1.  Returns weights and bias."""
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(x.shape[1], dtype=np.float32), 0.0
    alpha = np.zeros(len(y))
    q = (x * x).sum(axis=1) + 1.0 + 0.5 / c
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            g = y[i] * (float(x[i] @ w) + bias) - 1 + alpha[i] * 0.5 / c
            new = max(0.0, alpha[i] - g / q[i])
            if (d := (new - alpha[i]) * y[i]) != 0.0:
                alpha[i] = new
                w += np.float32(d) * x[i]
                bias += d
    return w, bias


@dataclass
class LangModel:
    """``pairs``: (level key, first class, second class); a positive margin is a vote for the first."""

    families: dict[str, list[str]] = field(default_factory=dict)
    pairs: list[tuple[str, str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, 0), dtype=np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def margins(self, texts: list[str]) -> np.ndarray:
        """Margins of every machine for every text, shape (texts, machines)."""
        n, k = len(texts), len(self.pairs)
        out = np.zeros((n, k))
        if not k or not n:
            return out
        raws = [_bytes(t) for t in texts]
        step = 1 << 20
        if n == 1 and len(raws[0]) > step:  # a very long text in slices that overlap by an n-gram less one byte
            sums, counts = np.zeros((len(GRAMS), k)), np.zeros(len(GRAMS))
            raw, back = np.frombuffer(raws[0], dtype=np.uint8), max(GRAMS) - 1
            for i in range(0, len(raw), step):
                lo = max(0, i - back)
                for g, c in enumerate(codes(raw[lo:i + step])):
                    c = c[i - lo - (GRAMS[g] - 1):] if i else c  # n-grams that end in this slice
                    sums[g] += self.weights[g][c].sum(axis=0, dtype=np.float64)
                    counts[g] += len(c)
            return (sums / np.maximum(counts, 1)[:, None]).sum(axis=0)[None, :] * SCALE + self.bias
        joined = np.frombuffer(b"".join(raws), dtype=np.uint8)
        ends = np.cumsum([len(r) for r in raws])
        starts = np.concatenate([[0], ends[:-1]])
        for g, c in enumerate(codes(joined)):
            size = GRAMS[g]
            score = self.weights[g][c]
            total = np.zeros((len(score) + 1, k))
            np.cumsum(score, axis=0, dtype=np.float64, out=total[1:])
            last = np.maximum(starts, ends - size + 1)  # n-grams that lie within the text
            out += (total[last] - total[starts]) / np.maximum(last - starts, 1)[:, None]
        return out * SCALE + self.bias

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if not self.families:
            return [(UNKNOWN, 0.0)] * len(texts)
        known = [has_letter(t) for t in texts]
        m = self.margins(texts)
        fams, sure = self._vote(m, "", sorted(self.families))
        result = []
        by_family = {f: self._vote(m, f, langs) for f, langs in self.families.items()}
        for i in range(len(texts)):
            if not known[i]:
                result.append((UNKNOWN, 0.0))
                continue
            langs, p = by_family[fams[i]]
            result.append((langs[i], float(min(1.0, max(0.0, sure[i] * p[i])))))
        return result

    def _vote(self, m: np.ndarray, level: str, classes: list[str]) -> tuple[list[str], np.ndarray]:
        """The class with most votes and the mean probability of its duels."""
        if len(classes) == 1:
            return classes * len(m), np.ones(len(m))
        place = {c: j for j, c in enumerate(classes)}
        votes, sums, prob = (np.zeros((len(m), len(classes))) for _ in range(3))
        for j, (lv, a, b) in enumerate(self.pairs):
            if lv == level:
                p = 1 / (1 + np.exp(-np.clip(2 * m[:, j], -30, 30)))
                for c, sign, q in ((a, 1, p), (b, -1, 1 - p)):
                    votes[:, place[c]] += sign * m[:, j] > 0
                    sums[:, place[c]] += sign * m[:, j]
                    prob[:, place[c]] += q
        best = (votes + 0.49 * np.tanh(sums / len(classes))).argmax(axis=1)
        return [classes[b] for b in best], prob[np.arange(len(m)), best] / (len(classes) - 1)


def fit(rows: list[tuple[str, str]]) -> LangModel:
    """``rows``: (language, text)."""
    rows = [(lang, t) for lang, t in rows if t and has_letter(t)]
    if not rows:
        return LangModel()
    langs = np.array([lang for lang, _ in rows])
    fams = np.array([family_of(lang) for lang in langs])
    x = np.stack([features(t) for _, t in rows])
    families = {str(f): sorted(str(v) for v in set(langs[fams == f])) for f in sorted(set(fams))}
    jobs = [("", a, b, fams) for a, b in combinations(sorted(families), 2)]
    jobs += [(f, a, b, langs) for f, members in families.items() for a, b in combinations(members, 2)]
    ws, bs, pairs = [], [], []
    for level, a, b, of in jobs:
        sel = (of == a) | (of == b)
        w, bias = linear_svm(x[sel], np.where(of[sel] == a, 1.0, -1.0))
        ws.append(w)
        bs.append(bias)
        pairs.append((level, a, b))
    weights = np.stack(ws, axis=1).reshape(len(GRAMS), 1 << DIM_BITS, len(pairs)) if pairs else np.zeros((len(GRAMS), 1 << DIM_BITS, 0))
    return LangModel(families, pairs, np.ascontiguousarray(weights, dtype=np.float32), np.array(bs))


def train(docs: DataFrame, folds: int = 4, held_out: int = 2, rows_per_lang: int = FIT_ROWS_PER_LANG,
          languages: int = FIT_LANGUAGES) -> LangModel:
    """Fit on the whole texts of at most ``rows_per_lang`` rows of each of the ``languages`` most frequent languages, outside the held-out fold.

    Rows are chosen by a hash of doc_id among the narrow columns; only then are
    the texts of that set read, in one pass.  Its size is bounded by
    ``languages`` times ``rows_per_lang``.
    """
    usable = docs.select("doc_id", "lang").where("lang is not null and doc_id is not null").where(fold(F.col("doc_id"), folds) != held_out)
    known = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    usable = usable.where(F.col("lang").isin([r["lang"] for r in known.collect()]))
    chosen = sample_by_hash(usable.dropDuplicates(), "doc_id", "lang", rows_per_lang).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi") \
        .select("doc_id", "lang", "text").collect()
    return fit([(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["text"] or ""))])


def predict_language(docs: DataFrame, model: LangModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` for each row's whole text (columns of these names are replaced)."""
    def work(texts: list[str]) -> list[list]:
        found = model.predict(texts)
        return [[p[0] for p in found], [p[1] for p in found]]

    return map_texts(docs, "text", {"lang_pred": "string", "score": "double"}, lambda: work)
