import random

import numpy as np
from pyspark.sql import functions as F

from voltframe.llm import toxicity


def corpus(n=500):
    """Toxic only where an insult meets a group: neither word tells it alone."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        insult, group = i % 2, i // 2 % 2
        words = rng.choices([f"w{k}" for k in range(40)], k=30) + ["Rotten"] * insult + ["Martians"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, insult * group))
    return rows, labels


def test_pairs_of_terms_are_learned(spark):
    rows, labels = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    said = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(df, said, F.col("doc_id") % 5 != 2)
    got = toxicity.score(df, model).collect()
    want = dict(labels)
    assert np.mean([r.predicted == want[r.doc_id] for r in got]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    rest = " ".join(f"w{k}" for k in range(0, 40, 2))
    alone, both = (toxicity.score(df.select(F.lit(f"{rest} {more}").alias("text")).limit(1), model).first().score
                   for more in ("rotten", "rotten martians"))
    assert alone < 0.3 < both


def test_scores_match_the_pairwise_sum(spark):
    rows, labels = corpus(80)
    df = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "ROTTEN " * 90_000), (None, "x")], "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels + [(0, 0), (None, 1), (3, None)], "doc_id long, toxic int"), F.lit(True))
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    for d, text in rows[:20] + [(900, ""), (902, "rotten")]:
        import pyarrow as pa
        place = {p for _, _, _, ps in toxicity._terms(pa.array([text])) for p in ps.tolist()}
        at = [i for i, p in enumerate(model.places.tolist()) if p in place]
        value = model.bias + sum(model.weight[i] for i in at) + sum(model.factors[i] @ model.factors[j] for i in at for j in at if i < j)
        assert abs(got[d] - 1 / (1 + np.exp(-value))) < 1e-9


def test_no_labels_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, Score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(df, none, F.lit(True))
    assert model is None and tuple(toxicity.score(df, model).first()) == (1, "x", 0.0, 0)
    assert toxicity.score(df.where("false"), model).count() == 0


def test_a_repeated_labelled_id_is_one_row_of_the_fit(spark, monkeypatch):
    rows, labels = corpus(80)
    seen, descend = [], toxicity._descend
    monkeypatch.setattr(toxicity, "_descend", lambda x, y, weight: seen.append((len(x), weight.max())) or descend(x, y, weight))
    more = [(3, f"w{i} w{i + 1}") for i in range(400)] + [(3, None)]
    said = spark.createDataFrame(labels, "doc_id long, toxic int")
    for docs in (rows, rows + more):
        toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), said, F.lit(True))
    assert seen[0] == seen[1] and seen[0][0] == 80
