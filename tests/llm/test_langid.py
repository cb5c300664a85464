"""Language identification: held-out accuracy and defined cases."""

import zlib

import numpy as np

from feedlake.llm import langid


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs)
    got = langid.predict_language(docs, model).toPandas()
    away = got["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)
    assert (got["lang_pred"] == got["lang"])[away].mean() > 0.96
    assert got["score"].between(0, 1).all()
    assert set(model.families) == {"germanic", "romance"}
    assert sorted(p[0] for p in model.pairs) == ["", "germanic", "romance"]


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(1, 0.3, (40, 5)), rng.normal(-1, 0.3, (40, 5))]).astype(np.float32)
    y = np.repeat([1.0, -1.0], 40)
    w, b = langid.linear_svm(x, y)
    assert (np.sign(x @ w + b) == y).all()


def test_defined_cases(spark):
    rows = [("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("es", "el perro y el gato"), ("fr", "le chien et le chat"), ("xx", "zzq qqz zzq")] * 4
    model = langid.fit(rows)
    assert model.families["other"] == ["xx"]
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "12² 34 _!?", "c"), (4, "the dog and the cat", None), (4, "the dog and the cat", None)],
                               "doc_id long, text string, lang string")
    got = [(r["doc_id"], r["lang_pred"]) for r in langid.predict_language(df, model).collect()]
    assert sorted(got) == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    assert langid.fit([]).predict(["text"]) == [("und", 0.0)]
    assert {p for p, _ in langid.fit([("en", "one two")]).predict(["x y"])} == {"en"}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.predict_language(empty, langid.train(empty)).collect() == []


def test_long_text_in_slices_equals_whole():
    model = langid.fit([("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("fr", "le chien et le chat")] * 3)
    long = "the Hund and le chat été " * 60000
    assert np.allclose(model.margins([long])[0], model.margins([long, "x"])[0], atol=1e-6)
