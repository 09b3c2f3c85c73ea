"""Shared pieces: Arrow batches with added columns, staged tables, text buffers and word hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.session import checkpoint_root, scratch_path

ROWS_PER_BATCH = 512
PIECE = 1 << 21          # bytes of text that one round of vector work covers


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches: a task holds a few hundred texts at once, whatever the partition."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    checkpoint_root(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and row
    ids given before the write stay fixed.  ``unstage`` removes it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(df: DataFrame) -> None:
    """Remove a staged table that nothing will read again."""
    drop_folder(df.sparkSession, df._staged_at)


def drop_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def with_columns(df: DataFrame, fn, fields: T.StructType, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` plus the columns that ``fn(record batch) -> list of Arrow arrays`` gives.

    ``fn`` sees all columns of ``df``.  Input columns named like a new one, and those in
    ``drop``, are not returned (names compare without case, as Spark's do)."""
    gone = {x.lower() for x in (*drop, *fields.names)}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in gone]
    schema = T.StructType([df.schema.fields[i] for i in kept] + fields.fields)
    names = schema.names

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                new = fn(batch)
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + list(new), names=names)

    return df.mapInArrow(run, schema)


def fields(**kinds) -> T.StructType:
    """StructType from name="type string"."""
    return T.StructType([T.StructField(k, T._parse_datatype_string(v) if isinstance(v, str) else v)
                         for k, v in kinds.items()])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column as one buffer, and the offsets of its rows (nulls are empty)."""
    a = column.fill_null("").cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_runs(offsets: np.ndarray, piece: int = PIECE):
    """Ranges of rows of about ``piece`` bytes each; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + piece, "right")) - 1)
        yield lo, hi
        lo = hi


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def letters_and_digits() -> np.ndarray:
    """Bytes of words: digits, a-z, and every byte of a character beyond ASCII."""
    t = np.zeros(256, bool)
    t[48:58] = t[97:123] = t[128:] = True
    return t


def not_blank() -> np.ndarray:
    """Bytes of words that only space and the controls 9 to 13 part."""
    t = np.ones(256, bool)
    t[32] = t[9:14] = False
    return t


def word_spans(low: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Starts and ends of the words in a buffer of texts, and each one's row; no word crosses
    the end of its text."""
    if not len(low):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = is_word[low]
    cut = np.zeros(len(low) + 1, bool)
    cut[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(offsets, starts, "right") - 1


POWERS = 4096


def word_hashes(low: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int = 7) -> np.ndarray:
    """A 64-bit polynomial hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    draw = np.random.default_rng(seed).integers(1, 2**63, 256 + POWERS, dtype=np.uint64)
    symbol, weight = draw[:256], draw[256:] | np.uint64(1)
    out = np.empty(len(starts), np.uint64)
    for a, b in word_runs(stops - starts):
        lens = stops[a:b] - starts[a:b]
        firsts = np.cumsum(lens) - lens
        nth = np.arange(int(lens.sum())) - np.repeat(firsts, lens)
        value = symbol[low[nth + np.repeat(starts[a:b], lens)]] * weight[nth % POWERS]
        out[a:b] = np.add.reduceat(value ^ (value >> np.uint64(31)), firsts)
    return out * np.uint64(0x9E3779B97F4A7C15) ^ (out >> np.uint64(29))


def word_runs(lens: np.ndarray, piece: int = PIECE):
    """Ranges of words of about ``piece`` bytes each, so a very long text takes no more at once."""
    yield from row_runs(np.append(0, np.cumsum(lens)), piece)


class Remembered(dict):
    """``make(key)`` of text keys, kept while a key recurs: two generations of ``size`` entries at
    most.  A full one becomes the old one, from which keys that recur move on.  Texts longer than
    ``longest`` are made anew each time."""

    def __init__(self, make, size: int, longest: int = 200):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got


class Lazy:
    """Something large that a worker makes from a small broadcast value when it first needs it.
    A worker keeps broadcast values between its tasks, and so what was made of them."""

    def __init__(self, make, *given):
        self.make, self.given, self.made = make, given, None

    def get(self):
        if self.made is None:
            self.made = self.make(*self.given)
        return self.made


def share_file(df: DataFrame, path: str, make):
    """A function that gives a task ``make(text of the file at path)``; the driver reads the file."""
    with open(path, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(Lazy(make, f.read()))
    return lambda: shared.value.get()


def hash_sample(df: DataFrame, group: str, key: list, size: int) -> DataFrame:
    """About ``size`` rows of each group, all of a smaller one: those whose hash of ``key`` lies
    below the group's share.  Takes one count by group and no shuffle of rows."""
    counts = df.where(F.col(group).isNotNull()).groupBy(group).count().collect()
    place = F.xxhash64(*key).cast("double") / F.lit(2.0**64) + 0.5
    share = F.lit(None).cast("double")
    for r in counts:
        share = F.when(F.col(group) == r[0], size / r["count"]).otherwise(share)
    return df.where(place < share)


def text_key(*cols) -> "F.Column":
    """A deterministic order for rows that share an id."""
    return F.xxhash64(*cols)


def under_aliases(df: DataFrame):
    """``df`` under names that no operator uses, the alias of each column, and the way back."""
    name = {c: f"col{i}_" for i, c in enumerate(df.columns)}
    return df.toDF(*name.values()), name, lambda out: out.select(*[F.col(a).alias(c) for c, a in name.items()])
