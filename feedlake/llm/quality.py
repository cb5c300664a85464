"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
text.  A text is compressed under both; text that resembles the good sample
comes out smaller under the good dictionary.  The difference of the two sizes,
divided by the text's length, is calibrated to a probability by logistic
regression on rows that the dictionaries were not built from.

Texts are compressed in windows of ``WINDOW`` bytes, all of them, so that the
difference stays comparable between short and very long texts and a text's own
repetitions don't drown the dictionaries.  One window's share is held within
``CLIP`` of its length: a passage that happens to stand in a dictionary word
for word says little about quality.  For the same reason the bad dictionary
leaves out pieces of bad texts that the other half of the sample finds good
(bad documents quote ordinary lines).

Defined cases: null and empty texts have difference 0 and get the calibrated
score of 0; repeated rows get equal scores; with fewer than four texts of one
class every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, labelled_sample, map_texts

WINDOW = 128
CLIP = 0.1
#: Bound of what is fitted on: rows of each class (their whole texts).
FIT_ROWS = 1500
PIECE = 256
DICT_BYTES = 200 * 1024
LEVEL = 3


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    weight: float
    bias: float

    def compressors(self) -> tuple:
        return compressor(self.good), compressor(self.bad)

    def score(self, differences) -> np.ndarray:
        z = np.clip(self.weight * np.asarray(differences, dtype=np.float64) + self.bias, -30, 30)
        return 1 / (1 + np.exp(-z))


def compressor(raw: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_dict_id=False)


def difference(text: str | bytes | None, good, bad) -> float:
    """(size under the bad dictionary - size under the good one) / length in bytes."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return 0.0
    total = 0.0
    for i in range(0, len(raw), WINDOW):
        part = raw[i:i + WINDOW]
        most = CLIP * len(part)
        total += max(-most, min(most, len(bad.compress(part)) - len(good.compress(part))))
    return total / len(raw)


def pieces(texts: list[str], rng: np.random.Generator) -> list[bytes]:
    """The distinct PIECE-byte pieces of the texts, in random order."""
    cut = {raw[i:i + PIECE]: None for t in texts for raw in (t.encode("utf-8", "surrogatepass"),) for i in range(0, len(raw), PIECE)}
    return [p for _, p in sorted(zip(rng.random(len(cut)), cut))]


def dictionary(parts: list[bytes], size: int = DICT_BYTES) -> bytes:
    """Raw dictionary content from the first pieces that fit."""
    return b"".join(parts)[:size].ljust(8, b"\x00")


def fit(rows: list[tuple[int, str]], seed: int = 7, rate: float | None = None) -> QualityModel:
    """``rows``: (label, text).  Half of each class makes the dictionary, the other half calibrates.

    ``rate``: the share of label 1 among all labels, if the rows are a sample by class.
    """
    rng = np.random.default_rng(seed)
    rows = [(int(y), t or "") for y, t in rows]
    if rate is None:
        rate = sum(y for y, _ in rows) / len(rows) if rows else 0.5
    rate = min(max(rate, 1e-3), 1 - 1e-3)
    by = {c: [t for y, t in rows if y == c and t] for c in (0, 1)}
    if len(by[0]) < 4 or len(by[1]) < 4:
        return QualityModel(b"\x00" * 8, b"\x00" * 8, 0.0, math.log(rate / (1 - rate)))
    halves = {c: [[texts[i] for i in part] for part in np.array_split(rng.permutation(len(texts)), 2)] for c, texts in by.items()}
    parts = {(c, h): pieces(halves[c][h], rng) for c in by for h in (0, 1)}
    other = compressor(dictionary(parts[1, 1])), compressor(dictionary(parts[0, 1]))
    bad = [p for p in parts[0, 0] if difference(p, *other) < 0] or parts[0, 0]
    model = QualityModel(dictionary(parts[1, 0]), dictionary(bad), 1.0, 0.0)
    pair = model.compressors()
    rest = [(c, t) for c in by for t in halves[c][1]]
    x = np.array([difference(t, *pair) for _, t in rest])
    y = np.array([c for c, _ in rest], dtype=np.float64)
    w = np.where(y == 1, rate / y.sum(), (1 - rate) / (1 - y).sum())
    scale = x.std() or 1.0
    a, b = 0.0, 0.0
    for _ in range(100):  # Newton steps for the two parameters
        p = 1 / (1 + np.exp(-np.clip(a * x / scale + b, -30, 30)))
        g = np.array([(w * (p - y) * x / scale).sum() + 1e-4 * a, (w * (p - y)).sum()])
        r = w * p * (1 - p)
        h = np.array([[(r * (x / scale) ** 2).sum() + 1e-4, (r * x / scale).sum()], [(r * x / scale).sum(), r.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return QualityModel(model.good, model.bad, float(a / scale), float(b))


def train(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, rows_per_class: int = FIT_ROWS) -> QualityModel:
    """Fit on at most ``rows_per_class`` labelled rows of each class, their whole texts, outside the held-out fold."""
    away = fold(F.col("doc_id"), folds) == held_out
    rate = labels.where(~away).where("doc_id is not null").agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    sample = labelled_sample(docs, labels, "quality", rows_per_class, held_out=away)
    rows = sample.select("doc_id", "y", "text").collect()
    return fit([(r["y"], r["text"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["y"], r["text"] or ""))], rate=rate)


def score_quality(docs: DataFrame, model: QualityModel, column: str = "quality_score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each row's whole text (a column of that name is replaced)."""
    def start():
        pair = model.compressors()
        return lambda texts: [model.score([difference(t, *pair) for t in texts]).tolist()]

    return map_texts(docs, "text", {column: "double"}, start)
