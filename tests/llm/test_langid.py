import zlib

import numpy as np

from churnkit.llm import langid as L

DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{DIR}/documents.parquet")
    got = L.label_languages(spark, df).join(df.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == df.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    assert (got.lang == got.lang_pred)[got.held_out].mean() > 0.98


def model(spark):
    df = spark.read.parquet(f"{DIR}/documents.parquet")
    return L.train(spark, df), df


def test_mixture_shares(spark, docs):
    """A text of two languages gets both, in their proportions; a text of one language gets one."""
    m, df = model(spark)
    one = {lang: " ".join(r["text"] for r in df.where(F_lang(lang)).limit(8).collect())[:6000] for lang in ("de", "fr")}
    mixed = one["de"][:4500] + " " + one["fr"][:1500]
    got = {r["doc_id"]: r for r in L.identify(docs([(1, mixed), (2, one["fr"]), (3, one["fr"][:4500] + " " + one["de"][:1500])]), m).collect()}
    assert got[1]["lang_pred"] == "de" and 0.6 < got[1]["score"] < 0.9
    assert got[2]["lang_pred"] == "fr" and got[2]["score"] > 0.97
    assert got[3]["lang_pred"] == "fr" and 0.6 < got[3]["score"] < 0.9


def F_lang(lang):
    return f"lang = '{lang}' AND n_chars BETWEEN 700 AND 5000"


def test_edges(spark, docs, clashing):
    m, _ = model(spark)
    rows = [(1, None), (2, ""), (3, "12 %% 3"), (4, "the and"), (None, "the"), (6, "que el " * 40_000), (4, "the and"), (8, "日")]
    got = L.identify(docs(rows), m).collect()
    assert len(got) == 8
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0) and by[4][0] in m.languages and by[8][0] in m.languages
    assert L.label_languages(spark, docs([])).count() == 0
    assert {r["lang_pred"] for r in L.label_languages(spark, docs(rows, lang=None)).collect()} == {"und"}
    kept = L.keep_identified(spark, clashing([(i, "some plain words of text") for i in range(8)] + [(9, "12"), (10, None)]))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(8)) and kept.columns == clashing([]).columns


def test_grams_do_not_cross_texts():
    whole = L.grams(["ab", "cd"], 14)
    parts = [L.grams([t], 14) for t in ("ab", "cd")]
    assert sorted(whole[0].tolist()) == sorted(np.concatenate([p[0] for p in parts]).tolist())
    assert whole[2].tolist() == [2, 2]
    assert sorted(L.grams(["  A--b "], 14)[0].tolist()) == sorted(L.grams(["a b"], 14)[0].tolist())


def test_columns_with_the_operators_names_stay(spark):
    rows = [(i, f"the quick brown fox number {'x' * (i % 3)} jumps", "en", "keep me", 0.25, "z") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, __language string, __share double, _free0 string")
    assert sorted(tuple(r) for r in L.keep_identified(spark, df).collect()) == rows
