import random

import numpy as np
from pyspark.sql import functions as F

from voltframe.llm import langid


def corpus(n=60):
    rng = random.Random(2)
    own = {"en": ["the", "and", "thing", "with", "shell"], "de": ["der", "und", "schön", "nicht", "ein"], "es": ["que", "los", "niño", "para", "una"]}
    return [(i, " ".join(rng.choices(own[lang], k=rng.randint(3, 40))), lang) for i in range(n) for lang in [list(own)[i % 3]]]


def test_held_out_documents_are_told_apart(spark):
    rows = corpus() + [(900, None, "en"), (901, "", "de"), (902, "123 -- !", "es"), (None, "the thing and the shell", None), (0, corpus()[0][1], "en"),
                       (903, "und " * 60_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = langid.held_out("doc_id", 3, 1)
    got = langid.identify(df, langid.fit(df, ~out)).select("*", out.alias("held")).collect()
    assert len(got) == len(rows) and sum(r.held for r in got) > 10
    for r in got:
        want = {900: "und", 901: "und", 902: "und", 903: "de"}.get(r.doc_id, r.lang or "en")
        assert r.lang_pred == want and (r.score == 0 if want == "und" else 0 < r.score <= 1)


def test_nystroem_with_all_landmarks_is_kernel_ridge_regression(spark):
    rows = corpus(45)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, F.lit(True), landmarks=45, ridge=1e-2)
    x = langid._unit(langid.presence([t for _, t, _ in rows])).astype(float)
    k = x @ x.T
    y = np.array([[1.0 if lang == n else -1.0 for n in model.languages] for _, _, lang in rows])
    want = k @ np.linalg.solve(k + 1e-2 * len(rows) * np.eye(len(rows)), y)
    got = (langid._unit(langid.presence([t for _, t, _ in rows])) @ model.landmarks) @ model.weights
    assert np.abs(got - want).max() < 0.02


def test_presence_does_not_depend_on_pieces():
    text = "abc déf " * 400
    whole = langid.presence([text])
    old = langid.PIECE_BYTES
    langid.PIECE_BYTES = 7
    try:
        assert (langid.presence([text]) == whole).all()
    finally:
        langid.PIECE_BYTES = old


def test_nothing_to_learn_and_filter(spark):
    df = spark.createDataFrame([(1, "text here", None, 1.5), (2, "12", None, 2.5), (3, None, None, None)], "doc_id long, text string, lang string, score double")
    model = langid.fit(df, F.lit(True))
    assert model is None
    assert {(r.lang_pred, r.score) for r in langid.identify(df, model).collect()} == {("und", 0.0)}
    kept = langid.keep_known(df, model)
    assert kept.columns == df.columns and [(r.doc_id, r.score) for r in kept.collect()] == [(1, 1.5)]
    assert langid.fit(df.where("false"), F.lit(True)) is None


def test_null_ids_teach_nothing(spark):
    rows = [(None, t, lang) for _, t, lang in corpus(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.fit(df, ~langid.held_out("doc_id", 3, 1)) is None and langid.fit(df, F.lit(True)) is None
    some = spark.createDataFrame(corpus(30), df.schema)
    model, both = (langid.fit(d, F.lit(True)) for d in (some, some.unionByName(df.withColumn("lang", F.lit("xx")))))
    assert model.languages == both.languages and np.allclose(model.weights, both.weights)


def test_kept_documents_get_a_language_where_they_have_none(spark):
    rows = [*corpus(30), (100, "und nicht schön der ein", None), (101, "...", None), (102, "the thing", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang for r in langid.keep_known(df, langid.fit(df.where("doc_id < 100"), F.lit(True))).collect()}
    assert got == {**{i: lang for i, _, lang in corpus(30)}, 100: "de", 102: "fr"}
