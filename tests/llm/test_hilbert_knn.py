import math

import numpy as np
from pyspark.sql import functions as F

from voltframe.llm import hilbert_knn

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, asked, k):
    good = {}
    sizes = [len(v) for i, v in rows if i is not None and usable(v)]
    common = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    for i, v in rows:
        if i is not None and usable(v) and len(v) == common:
            good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in good:
        if asked(q):
            near = sorted((math.sqrt(((good[q] - x) ** 2).sum()), i) for i, x in good.items() if i != q)
            out[q] = near[:k]
    return out


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def found(spark, rows, asked, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = {}
    for r in hilbert_knn.search(df, asked, **kw).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert len(out[r.query_id]) == r.rank
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12, atol=1e-12)


def test_hilbert_keys_visit_each_cell_once_in_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(np.ndindex(*[1 << bits] * dims)))
        keys = hilbert_knn.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_whole_windows_match_brute_force_with_copies_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(90)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(5, rows[5][1])]
    rows += [(300, None), (310, []), (320, [0.0] * 6), (330, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (340, [float("nan")] * 6), (350, [float("inf")] + [1.0] * 5),
             (None, rows[1][1]), (360, [1.0, 2.0])]
    want = brute(rows, lambda q: q % 5 == 0, 10)
    same(found(spark, rows, F.col("id") % 5 == 0, share=2.0, curves=3, block=16), want)


def test_fewer_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [5.0, 5.0])]
    same(found(spark, rows, F.col("id") % 2 == 0), brute(rows, lambda q: q % 2 == 0, 10))
    assert found(spark, [], F.col("id") % 2 == 0) == {}
    assert found(spark, [(0, [1.0, 2.0])], F.col("id") % 2 == 0) == {}


def test_recall_of_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, lambda q: q % 100 == 0, 10)
    got = {}
    for r in hilbert_knn.search(df, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(got[q] & {i for _, i in want[q]}) / len(want[q]) for q in want])
    assert got.keys() == want.keys() and recall >= 0.9


def test_recall_with_a_third_of_the_rows_in_one_tight_cluster(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=64)
    for jitter in (0.03, 0.0005):
        rows = [(i, (centre + jitter * rng.normal(size=64) if i % 3 == 0 else rng.normal(size=64)).tolist()) for i in range(6000)]
        want = brute(rows, lambda q: q % 60 == 0, 10)
        got = found(spark, rows, F.col("id") % 60 == 0)
        recall = np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want])
        assert got.keys() == want.keys() and recall >= 0.95, (jitter, recall)


def test_finer_keys_extend_coarse_ones():
    cells = np.random.default_rng(2).integers(0, 1 << 12, (500, 5))
    coarse = hilbert_knn.hilbert_keys(cells >> 9, 3)
    assert (hilbert_knn.hilbert_keys(cells, 12) >> 45 == coarse).all()


def test_an_id_with_two_vectors_has_one_of_them(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    again = [(0, rng.normal(size=4).tolist()), (2, rng.normal(size=4).tolist()), (7, [0.0] * 4), (9, None)]
    df = spark.createDataFrame(rows + again, SCHEMA)
    kept = {r.id: list(r.vec) for r in hilbert_knn.one_vector(df, "vec_id", "embedding").collect()}
    assert len(kept) == 40 and all(any(np.allclose(v, x) for j, x in rows + again if j == i and x) for i, v in kept.items())
    want = brute(list(kept.items()), lambda q: q % 2 == 0, 10)
    same(found(spark, rows + again, F.col("id") % 2 == 0), want)
    same(found(spark, (rows + again)[::-1], F.col("id") % 2 == 0), want)
