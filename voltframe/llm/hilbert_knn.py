"""Approximate nearest neighbours by shifted Hilbert curves.

Each of ``CURVES`` curves has its own random orthogonal projection to ``DIMS`` dimensions and its own
shift; a vector's place on it is the Hilbert key of its quantised projection: ``BITS`` a dimension,
then ``FINE`` more, which part the rows of a cell however tight a cluster they are (down to a
float's precision); equal keys follow a hash of their own for each curve.  Per curve Spark
range-partitions and sorts the keys, and counts by partition turn the order into positions.  A
query looks at the rows within ``window`` positions on either side of it on every curve.  Positions
are cut into blocks of ``BLOCK`` rows at most, a query goes to each block that its window meets, and
each block ranks its rows by exact distance and returns the nearest few: neither pairs nor more
than a block ever meet in one task.  The curves' answers are merged and ranked again.

Equal vectors are one entry of the curves with its k + 1 smallest ids, which is all that a list of
k neighbours with ties to smaller ids can hold; so a vector that a third of all rows share costs
no more than another.  Only scale and centre of the projections are fitted, on ``SAMPLE`` vectors
in the order of a hash of their ids; every row is indexed.

The window is a share of the rows.  How much of them must be looked at depends on the data alone:
vectors without structure need a large share for a recall of 0.9, clustered ones little.

Defined cases: null ids, null vectors, zero vectors, vectors with a null or non-finite component
and those of another than the most frequent length take no part; an id that comes more than once has one
vector, that of the least hash among its usable ones; fewer candidates than k give shorter lists; an empty table gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.llm.common import stage, unstage

CURVES, DIMS, BITS, FINE = 12, 16, 3, 21
SHARE, LEAST_WINDOW = 0.12, 64
BLOCK, SAMPLE = 4096, 2000


def _hilbert_bits(cells: np.ndarray, bits: int) -> np.ndarray:
    """Bits of the position on the Hilbert curve of each row of non-negative integers below
    2^bits, highest first.  The leading ones are the position among cells of fewer bits."""
    x = cells.astype(np.int64).copy()
    n, dims = x.shape
    for level in range(bits - 1, 0, -1):
        top, rest = 1 << level, (1 << level) - 1
        for i in range(dims):
            flip = (x[:, i] & top) > 0
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, i]) & rest)
            x[:, 0] ^= np.where(flip, rest, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    carry = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        carry ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= carry[:, None]
    levels = np.arange(bits - 1, -1, -1)
    return (x[:, None, :] >> levels[None, :, None] & 1).astype(np.uint8).reshape(n, -1)


def _number(bits: np.ndarray) -> np.ndarray:
    key = np.zeros(len(bits), np.int64)
    for column in bits.T:
        key = key << 1 | column
    return key


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of non-negative integers below 2^bits."""
    return _number(_hilbert_bits(cells, bits))


def _usable(vec: Column) -> Column:
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(sound, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def one_vector(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """One usable vector for each id, the one of the least hash, and its two hashes: id, vec, a, b."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    v = v.where(F.col("id").isNotNull() & _usable(F.col("vec")))
    least = F.min(F.struct(F.xxhash64("vec").alias("a"), F.xxhash64("vec", F.lit(1)).alias("b"), F.col("vec"))).alias("least")
    return v.groupBy("id").agg(least).select("id", "least.vec", "least.a", "least.b")


def entries(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """One row for each distinct usable vector: rep (its smallest id), ids (its k + 1 smallest), vec."""
    v = one_vector(vectors, id_col, vec_col)
    common = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    v = v.where(F.size("vec") == (common.d if common else 0))
    nth = F.dense_rank().over(Window.partitionBy("a", "b").orderBy("id"))
    v = v.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return v.groupBy("a", "b").agg(F.min("id").alias("rep"), F.array_sort(F.collect_set("id")).alias("ids"),
                                   F.min_by("vec", "id").alias("vec")).select("rep", "ids", "vec")


def _curves(sample: np.ndarray, curves: int, dims: int, seed: int):
    """Projection, and scale and shift to the unit cube with room for the shift, of each curve."""
    rng, d = np.random.default_rng(seed), sample.shape[1]
    out = []
    for _ in range(curves):
        basis = np.linalg.qr(rng.normal(size=(d, d)))[0][:, :min(dims, d)]
        y = sample @ basis
        spread = np.maximum(y.std(axis=0), 1e-12)
        out.append((basis, y.mean(axis=0), 16 * spread, 0.25 + 0.5 * rng.random(basis.shape[1])))
    return out


def _keys(reps: DataFrame, curves, bits: int, fine: int = FINE) -> DataFrame:
    """One row for each curve and entry: the key of ``bits`` a dimension, and the next ``fine``."""
    shared = reps.sparkSession.sparkContext.broadcast(curves)

    def run(batches):
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            side = 1 << (bits + fine)
            for c, (basis, mean, scale, shift) in enumerate(shared.value):
                cells = np.clip(((x @ basis - mean) / scale + shift) * side, 0, side - 1).astype(np.int64)
                key, more = np.split(_hilbert_bits(cells, bits + fine), [bits * cells.shape[1]], axis=1)
                more = pa.array([row.tobytes() for row in np.packbits(more, axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), c, np.int32)), pa.array(_number(key)), more, pa.array(ids)],
                                                 names=["curve", "key", "fine", "rep"])

    return reps.select("rep", "vec").mapInArrow(run, "curve int, key long, fine binary, rep long")


def positions(keys: DataFrame) -> DataFrame:
    """``keys`` (curve, key, fine, rep) to curve, rep and position on the curve, counted from 0; staged."""
    keys = keys.withColumn("tie", F.xxhash64("curve", "rep"))
    order = ["curve", "key", "fine", "tie", "rep"]
    laid = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = stage(laid.select("curve", "rep", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("nth")), "curve-order")
    # one row for each curve and partition that has rows of it
    parts = laid.groupBy("curve", "part").agg(F.min("nth").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    pos = (F.col("base") + F.col("nth") - F.col("first")).alias("pos")
    out = stage(laid.join(F.broadcast(parts), ["curve", "part"]).select("curve", "rep", pos), "positions")
    unstage(laid)
    return out


def _nearest(x: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int):
    """Indices and distances of the k rows nearest to ``q``, ties to smaller ids."""
    rough = (x * x).sum(axis=1) - 2 * (x @ q) + q @ q
    if len(x) > k:
        edge = np.partition(rough, k - 1)[k - 1]
        near = np.flatnonzero(rough <= edge + 1e-9 * (1 + abs(edge) + q @ q))
    else:
        near = np.arange(len(x))
    exact = np.sqrt(((x[near] - q) ** 2).sum(axis=1))
    order = np.lexsort((ids[near], exact))[:k]
    return near[order], exact[order]


def search(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           curves: int = CURVES, dims: int = DIMS, bits: int = BITS, share: float = SHARE, block: int = BLOCK,
           seed: int = 5) -> DataFrame:
    """The ``k`` nearest rows found for each row that ``queries`` (a condition on its id, as column
    ``id``) picks: query_id, rank, vec_id, score (Euclidean distance)."""
    if dims * bits > 63:
        raise ValueError("a key has 63 bits")
    reps = stage(entries(vectors, id_col, vec_col, k), "vectors")
    n = reps.count()
    sample = reps.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vec").collect()
    spec = _curves(np.array([r.vec for r in sample], float).reshape(len(sample), -1), curves, dims, seed) if sample else []
    at = positions(_keys(reps, spec, bits))
    window = max(LEAST_WINDOW, math.ceil(n * share / 2))
    size = min(block, window)
    here = at.withColumn("block", F.floor(F.col("pos") / size))
    rows = here.join(reps.select("rep", "vec"), "rep").select("curve", "block", "rep", "vec", "pos")
    asked = one_vector(vectors, id_col, vec_col).where(queries).select("id", "a", "b")
    mine = reps.select("rep", F.xxhash64("vec").alias("a"), F.xxhash64("vec", F.lit(1)).alias("b"))
    asked = stage(asked.join(mine, ["a", "b"]).select("id", "rep"), "queries")
    first, last = F.floor((F.greatest(F.lit(0), F.col("pos") - window)) / size), F.floor((F.col("pos") + window) / size)
    looked = at.join(asked.select("rep").distinct(), "rep").withColumn("block", F.explode(F.sequence(first, last)))
    looked = looked.join(reps.select("rep", "vec"), "rep").select("curve", "block", "rep", "vec", "pos")
    looked = looked.toDF(*looked.columns)              # columns of its own, as both sides come from the same tables
    kinds = pa.schema([("query", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])

    def rank(left, right):
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            x, ids, pos = _matrix(left["vec"]), left["rep"].to_numpy(), left["pos"].to_numpy()
            for q, own, place in zip(_matrix(right["vec"]), right["rep"].to_pylist(), right["pos"].to_pylist()):
                inside = np.flatnonzero(np.abs(pos - place) <= window)
                if len(inside):
                    near, score = _nearest(x[inside], ids[inside], q, k + 1)
                    out[0] += [own] * len(near)
                    out[1] += ids[inside][near].tolist()
                    out[2] += score.tolist()
        return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(out, kinds)], schema=kinds)

    found = rows.groupBy("curve", "block").cogroup(looked.groupBy("curve", "block")).applyInArrow(rank, "query long, rep long, score double")
    found = found.groupBy("query", "rep").agg(F.min("score").alias("score"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy("score", "rep"))
    found = found.withColumn("nth", nth).where(F.col("nth") <= k + 1).select("query", "rep", "score")
    found = found.join(reps.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    found = stage(found.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth"), "near")    # k + 1 a distinct vector
    out = asked.join(found, asked.rep == found.query).where("vec_id <> id")
    nth = F.row_number().over(Window.partitionBy("id").orderBy("score", "vec_id")).alias("rank")
    return out.select(F.col("id").alias("query_id"), nth, "vec_id", "score").where(F.col("rank") <= k)
