"""Toxicity by a factorization machine over hashed terms.

Terms are the lower-cased words of a text (digits, letters, characters beyond ASCII) and their
first 3 to 8 bytes, which an insult keeps in all its forms, hashed to 2^22 places; a text is the set
of its terms.  The model is a bias, a weight for each kept place and
a vector of ``FACTORS`` numbers for each, whose products are the weights of pairs of terms: an insult
next to a group's name can count for more than both alone, which a sum of term weights can't tell.

``fit`` takes about ``PER_CLASS`` labelled texts of each class, chosen by a hash of their id, one
text (the least by a hash of it) for an id that comes in many rows,
keeps the ``PLACES`` places whose presence tells most about the label (chi-squared, counted in
Spark over the sample), and minimises the weighted logistic loss by Adam on the driver, whose
share is about 2 x PER_CLASS rows of PLACES bits.  Each class weighs as much as it does among
all labelled rows, so scores are probabilities.

Defined cases: null and empty texts hold no term and get the score of the bias; a document
labelled more than once counts as toxic if any label says so; null labels and ids teach nothing;
with no labelled row every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import (fields, hash_sample, letters_and_digits, lower_table, row_runs, stage, unstage, utf8,
                                  with_columns, word_hashes, word_spans)

HASH_BITS = 22
PER_CLASS, PLACES, FACTORS = 6000, 1024, 8
STEMS = (3, 4, 5, 6, 7, 8)
ROUNDS, RATE, SHRINK = 150, 0.05, 2e-5
THRESHOLD = 0.3


@dataclass
class Model:
    places: np.ndarray      # sorted
    bias: float
    weight: np.ndarray
    factors: np.ndarray


def _terms(column, shift=np.uint64(64 - HASH_BITS)):
    """For each run of rows: first row, number of rows, and row and place of every term."""
    lower, is_word = lower_table(), letters_and_digits()
    data, offsets = utf8(column)
    for lo, hi in row_runs(offsets):
        low = lower[data[offsets[lo]:offsets[hi]]]
        s, e, row = word_spans(low, offsets[lo:hi + 1] - offsets[lo], is_word)
        rows, places = [row], [word_hashes(low, s, e)]
        for n in STEMS:
            longer = np.flatnonzero(e - s > n)
            rows.append(row[longer])
            places.append(word_hashes(low, s[longer], s[longer] + n, seed=100 + n))
        yield lo, hi - lo, np.concatenate(rows), (np.concatenate(places) >> shift).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, text_col: str = "text", id_col: str = "doc_id",
        label_col: str = "toxic", per_class: int = PER_CLASS) -> Model | None:
    """Learn from the labelled rows for which ``learn`` (a condition on the id column) holds."""
    said = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learn)
    said = said.groupBy(id_col).agg(F.max((F.col(label_col) == 1).cast("int")).alias("y"))
    totals = {r.y: r["count"] for r in said.groupBy("y").count().collect()}
    sample = hash_sample(said, "y", [F.col(id_col).cast("string")], per_class).select(id_col, "y")
    # about 2 x per_class rows of two numbers
    texts = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(sample), id_col)
    order = F.struct(F.xxhash64("text"), F.col("text"))
    texts = texts.groupBy(id_col, "y").agg(F.min_by("text", order).alias("text")).select("text", "y")    # combined before its shuffle

    def places(batch):
        out = [None] * batch.num_rows
        for lo, n, row, place in _terms(batch.column(0)):
            pairs = np.unique(row << HASH_BITS | place)
            r, p = pairs >> HASH_BITS, (pairs & ((1 << HASH_BITS) - 1)).astype(np.int32)
            cut = np.searchsorted(r, np.arange(n + 1))
            out[lo:lo + n] = [p[cut[i]:cut[i + 1]] for i in range(n)]
        return [pa.array(out, pa.list_(pa.int32()))]

    rows = stage(with_columns(texts, places, fields(places="array<int>"), drop=("text",)), "toxicity-sample")
    have = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if not have:
        unstage(rows)
        return None
    n, pos = sum(have.values()), have.get(1, 0)
    seen = rows.select("y", F.explode("places").alias("place")).groupBy("place").agg(
        F.count("*").alias("c"), F.sum("y").alias("p")).where("c >= 3")
    gap = F.col("p") - F.col("c") * F.lit(pos / n)
    best = seen.orderBy((gap * gap / F.col("c")).desc(), "place").limit(PLACES).select("place").collect()
    kept = np.array(sorted(r.place for r in best), np.int64)
    chosen = F.array(*[F.lit(int(p)) for p in kept]) if len(kept) else F.array().cast("array<int>")
    got = rows.select("y", F.array_intersect("places", chosen).alias("places")).collect()
    unstage(rows)
    x = np.zeros((len(got), len(kept)), np.float32)
    for i, r in enumerate(got):
        x[i, np.searchsorted(kept, r.places)] = 1
    y = np.array([r.y for r in got], np.float32)
    share = {k: totals.get(k, v) / v for k, v in have.items()}
    weight = np.array([share[int(v)] for v in y], np.float32)
    return Model(kept, *_descend(x, y, weight / weight.sum()))


def _descend(x, y, weight):
    """Full-batch Adam on the weighted logistic loss of the machine."""
    rng = np.random.default_rng(11)
    mean = float((weight * y).sum())
    now = [np.float32(np.log((mean + 1e-4) / (1 - mean + 1e-4))), np.zeros(x.shape[1], np.float32),
           rng.normal(0, 0.02, (x.shape[1], FACTORS)).astype(np.float32)]
    first, second = [np.zeros_like(p) for p in now], [np.zeros_like(p) for p in now]
    order = np.lexsort((y, x.sum(axis=1)))
    x, y, weight = x[order], y[order], weight[order]
    for t in range(1, ROUNDS + 1):
        sums = x @ now[2]
        value = now[0] + x @ now[1] + 0.5 * ((sums * sums).sum(axis=1) - x @ (now[2] ** 2).sum(axis=1))
        miss = weight * (1 / (1 + np.exp(-np.clip(value, -30, 30))) - y)
        slope = [miss.sum(), x.T @ miss + SHRINK * now[1],
                 x.T @ (sums * miss[:, None]) - now[2] * (x.T @ miss)[:, None] + SHRINK * now[2]]
        for k in range(3):
            first[k] = 0.9 * first[k] + 0.1 * slope[k]
            second[k] = 0.999 * second[k] + 0.001 * slope[k] ** 2
            now[k] = now[k] - RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return float(now[0]), now[1].astype(np.float64), now[2].astype(np.float64)


def score(docs: DataFrame, model: Model | None, text_col: str = "text", drop: tuple[str, ...] = (),
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus score and predicted."""
    at = docs.columns.index(text_col)
    shared, state = docs.sparkSession.sparkContext.broadcast(model), {}

    def run(batch):
        model = shared.value
        out = np.zeros(batch.num_rows)
        if model is not None:
            if not state:
                state["of"] = np.full(1 << HASH_BITS, -1, np.int16 if len(model.places) < 2**15 else np.int32)
                state["of"][model.places] = np.arange(len(model.places))
            for lo, n, row, place in _terms(batch.column(at)):
                term = state["of"][place]
                pairs = np.unique(row[term >= 0] * len(model.places) + term[term >= 0]) if len(model.places) else row[:0]
                r, t = np.divmod(pairs, max(1, len(model.places)))
                sums = np.zeros((n, FACTORS))
                np.add.at(sums, r, model.factors[t])
                own = (model.factors[t] ** 2).sum(axis=1)
                alone = np.bincount(r, model.weight[t] - 0.5 * own, minlength=n)
                value = model.bias + alone + 0.5 * (sums * sums).sum(axis=1)
                out[lo:lo + n] = 1 / (1 + np.exp(-np.clip(value, -30, 30)))
        return [pa.array(out, pa.float64()), pa.array((out >= threshold).astype(np.int32), pa.int32())]

    return with_columns(docs, run, fields(score="double", predicted="int"), drop)
