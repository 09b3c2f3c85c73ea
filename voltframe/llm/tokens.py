"""Token ids as flat binary files, and exact counts of encoded lengths.

``write`` lays a corpus out in ascending id order: the rows are range-partitioned by id, and each
partition becomes one shard of three files, all little-endian: ``.bin`` (the ids, unsigned, 2
bytes each if the vocabulary allows, else 4), ``.off`` (unsigned 64-bit: where each document
begins among all ids of the corpus, and the end) and ``.ids`` (document ids, 64-bit, then one byte
each that is 0 for a null id).  A first pass writes the ids and counts them by shard; prefix sums
over the shards' counts give each shard's base, and the offsets are written from it.  ``read``
maps the files and returns them document by document.  A file is written under a name of the
attempt and then renamed, so a task that runs twice leaves the same files.

Files go where ``folder`` points; folders of the local machine's file system (or mounted there)
are memory-mapped, others are read through pyarrow's file systems.

Defined cases: null text is empty and holds the end id only; null ids come first; rows of one id
stand in the order of a hash of their text; an empty table gives no shard.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltframe.llm.bpe import BLANK, PROBES, byte_letters
from voltframe.llm.common import Remembered, fields, share_file, stage, with_columns

END = 2
KEPT = 400_000
SHARD = "shard string, docs long, tokens long"


# The letters of ASCII, Latin-1 and Latin Extended-A, as ranges of a pattern.
LETTERS = "A-Za-z" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x17F)))


class Encoder:
    """The library's ids of whole texts, made word by word.  Where a text has ASCII and Latin
    letters only, what the vocabulary's split does to it is plain, and its words recur: only new
    ones go to the library's model.  Other texts part before each blank, where no token
    crosses, and the pieces that have other characters go to the library whole; so do texts that
    spell out a special token."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = json.loads(spec)
        self.library = Tokenizer.from_str(spec)
        self.model = self.library.model
        self.width = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        special = [t["content"] for t in model["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.runs = re.compile(rf" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
        self.split = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^{BLANK}{LETTERS}0-9]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
        self.other = re.compile(rf"[^\x00-\x7f{LETTERS}]")
        self.letters = byte_letters()
        self.words = Remembered(self.word_ids, KEPT)
        self.pieces = Remembered(self.piece_ids, KEPT // 4)
        for text in PROBES:
            if self.one(text) != self.whole(text):
                raise ValueError("this vocabulary splits texts in another way than this encoder")

    def word_ids(self, word: str) -> bytes:
        found = self.model.tokenize("".join([self.letters[b] for b in word.encode()]))
        return np.array([t.id for t in found], self.width).tobytes()

    def piece_ids(self, piece: str) -> bytes:
        return self.by_words(piece) if self.other.search(piece) is None else self.whole(piece)

    def by_words(self, text: str) -> bytes:
        words = self.words
        return b"".join([words[w] for w in self.split.findall(text)])

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special and self.special.search(text):
            return self.whole(text)
        if text.isascii() or self.other.search(text) is None:
            return self.by_words(text)
        pieces = self.pieces
        return b"".join([pieces[p] for p in self.runs.findall(text)])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self.one(t) for t in texts]


def lengths(docs: DataFrame, path: str, text_col: str = "text", out: str = "n_tokens", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus the number of ids of each text (0 for null)."""
    get, at = share_file(docs, path, Encoder), docs.columns.index(text_col)

    def run(batch):
        enc = get()
        size = np.dtype(enc.width).itemsize
        return [pa.array([len(x) // size for x in enc.encode(batch.column(at).to_pylist())], pa.int64())]

    return with_columns(docs, run, fields(**{out: "bigint"}), drop)


def histogram(lens: DataFrame, col: str = "n_tokens", block: int = 1024) -> DataFrame:
    """For each encoded length that occurs, as a context limit: documents of that length, of at
    least that length, at most that length (``share`` of all, the quantile it stands for), tokens
    in all, and tokens that remain if every document is cut there.

    Documents are counted by length first; what follows works on the distinct lengths only, in
    blocks of ``block`` lengths whose sums are added up.  An empty table gives no row."""
    h = lens.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("context_limit")).agg(F.count("*").alias("n_docs"))
    h = stage(h.withColumn("block", F.floor(F.col("context_limit") / block)), "lengths")
    b = h.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("context_limit")).alias("tokens"))
    below = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)   # one row for each block of lengths
    total = Window.partitionBy()
    b = b.select("block", *(F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"{c}_before") for c in ("docs", "tokens")),
                 *(F.sum(c).over(total).alias(f"all_{c}") for c in ("docs", "tokens")))
    within = Window.partitionBy("block").orderBy("context_limit").rowsBetween(Window.unboundedPreceding, 0)
    up_to = h.withColumn("docs_in", F.sum("n_docs").over(within)).withColumn(
        "tokens_in", F.sum(F.col("n_docs") * F.col("context_limit")).over(within)).join(b, "block")
    at_most = F.col("docs_before") + F.col("docs_in")
    longer = F.col("all_docs") - at_most
    return up_to.select("context_limit", "n_docs", (longer + F.col("n_docs")).alias("docs_at_least"), at_most.alias("docs_at_most"),
                        (at_most / F.col("all_docs")).alias("share"), F.col("all_tokens").alias("total_tokens"),
                        (F.col("tokens_before") + F.col("tokens_in") + longer * F.col("context_limit")).alias("truncated_tokens"))


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least each share of the documents doesn't exceed."""
    return hist.select(F.explode(F.array(*map(F.lit, shares))).alias("q"), "context_limit", "share").where(
        "share >= q").groupBy("q").agg(F.min("context_limit").alias("n_tokens"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """The histogram's answers for any context limits, lengths that occur or not: context_limit,
    docs_at_most, docs_longer, total_tokens and truncated_tokens.  No row for an empty histogram."""
    # the longest length up to each limit: what is cut there is cut a little later at the limit
    found = F.struct("context_limit", "docs_at_most", "truncated_tokens")
    asked = sorted({int(x) for x in limits})
    near = [F.max_by(found, F.when(F.col("context_limit") <= x, F.col("context_limit"))).alias(f"h{i}") for i, x in enumerate(asked)]
    one = hist.agg(F.max("docs_at_most").alias("docs"), F.max("total_tokens").alias("tokens"), *near).where("docs IS NOT NULL")
    rows = one.select("docs", "tokens", F.explode(F.array(*(F.struct(F.lit(x).cast("long").alias("limit"), F.col(f"h{i}").alias("h"))
                                                             for i, x in enumerate(asked)))).alias("r")).select("docs", "tokens", "r.limit", "r.h")
    at_most = F.coalesce("h.docs_at_most", F.lit(0))
    longer = F.col("docs") - at_most
    cut = F.coalesce(F.col("h.truncated_tokens") + (F.col("limit") - F.col("h.context_limit")) * longer, F.col("limit") * longer)
    return rows.select(F.col("limit").alias("context_limit"), at_most.alias("docs_at_most"), longer.alias("docs_longer"),
                       F.col("tokens").alias("total_tokens"), cut.alias("truncated_tokens"))


def _open(uri: str):
    """(file system, path in it) of a folder given as Spark names it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + os.path.abspath(uri))


def _uri(uri: str) -> str:
    return re.sub(r"^file:/+", "file:///", uri)


def _put(folder: str, name: str, pieces) -> None:
    """Write a file whole or not at all."""
    where, root = _open(_uri(folder))
    where.create_dir(root, recursive=True)
    own = f"{root}/.{name}-{uuid.uuid4().hex}"
    with where.open_output_stream(own, compression=None) as f:
        for p in pieces:
            f.write(p)
    where.move(own, f"{root}/{name}")


def _map(folder: str, name: str, kind: str) -> np.ndarray:
    where, root = _open(_uri(folder))
    if isinstance(where, fs.LocalFileSystem):
        path = f"{root}/{name}"
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with where.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read(), kind)


def write(docs: DataFrame, path: str, folder: str, text_col: str = "text", id_col: str = "doc_id", end: int = END) -> DataFrame:
    """Write the corpus under ``folder``; returns the staged table of shards: shard, docs,
    tokens and base (ids of all shards before)."""
    get = share_file(docs, path, Encoder)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # rows of one id spread too: by a hash of the text, and equal rows by where they were read
    place = [F.col("id").asc_nulls_first(), F.col("hash"), F.col("nth")]
    rows = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("nth"))
    rows = rows.repartitionByRange(*place).sortWithinPartitions(*place).select("id", "text", F.spark_partition_id().alias("part"))

    def shard(batches):
        enc, ids, sizes, part = get(), [], [], None
        stop = np.array([end], enc.width).tobytes()
        size = np.dtype(enc.width).itemsize
        tail = []

        def pieces():
            nonlocal part
            for batch in batches:
                part = batch.column(2)[0].as_py() if batch.num_rows and part is None else part
                for got in enc.encode(batch.column(1).to_pylist()):
                    sizes.append(len(got) // size + 1)
                    yield got + stop
                ids.append(batch.column(0))

        stream = pieces()
        tail = next(stream, None)
        if tail is None:
            return
        name = f"shard-{part:05d}"

        def all_pieces():
            yield tail
            yield from stream

        _put(folder, f"{name}.bin", all_pieces())
        column = pa.concat_arrays(ids)
        _put(folder, f"{name}.ids", [column.fill_null(0).to_numpy().astype("<i8").tobytes(),
                                     column.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()])
        _put(folder, f"{name}.len", [np.array(sizes, "<u8").tobytes()])
        yield pa.RecordBatch.from_pylist([{"shard": name, "docs": len(sizes), "tokens": int(sum(sizes))}],
                                         schema=pa.schema([("shard", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    spark = docs.sparkSession
    counts = stage(rows.mapInArrow(shard, SHARD), "shards")
    # one row for each shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = stage(counts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))), "shard-bases")

    def offsets(batches):
        for batch in batches:
            for r in batch.to_pylist():
                lens = _map(folder, f"{r['shard']}.len", "<u8")
                _put(folder, f"{r['shard']}.off", [(np.concatenate([[0], np.cumsum(lens)]) + r["base"]).astype("<u8").tobytes()])
            yield batch

    placed = _spread(spark, shards).mapInArrow(offsets, shards.schema)
    return stage(placed.withColumn("width", F.lit(get().width)), "shards-placed")


def _spread(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """The shards dealt over the tasks, none of which reads more than its own."""
    return shards.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard")


def read(shards: DataFrame, folder: str) -> DataFrame:
    """One row for each document from the files: doc_id, start, n_tokens, ids_crc32."""
    def run(batches):
        kinds = [pa.int64()] * 4
        for batch in batches:
            for r in batch.to_pylist():
                flat, offs = _map(folder, f"{r['shard']}.bin", r["width"]), _map(folder, f"{r['shard']}.off", "<u8").astype(np.int64)
                raw = _map(folder, f"{r['shard']}.ids", "u1")
                n = len(offs) - 1
                ids, there = np.frombuffer(raw[:8 * n].tobytes(), "<i8"), np.asarray(raw[8 * n:]).astype(bool)
                for lo in range(0, n, 4096):
                    hi = min(n, lo + 4096)
                    cuts = (offs[lo:hi + 1] - offs[0]).tolist()
                    crc = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
                    cols = [pa.array(ids[lo:hi], mask=~there[lo:hi]), pa.array(offs[lo:hi]), pa.array(np.diff(offs[lo:hi + 1])), pa.array(crc)]
                    yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(cols, kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _spread(shards.sparkSession, shards).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
