"""Removal of repeated byte strings with suffix order: every byte inside a string of ``length``
bytes that also begins anywhere else goes.

Sorting all suffixes of a corpus moves many times its size, so the suffixes that can't be in a
repeat are set aside first, without loss.  For each start the anchor is the 64-byte string of
least hash among those inside its ``length`` bytes (the last, if equal): the same bytes choose the
same anchor.  Starts of one anchor form a range; an anchor hash that occurs once in the corpus
can't be in a repeat.  The other ranges, with the bytes that their starts reach, go to shards by
the anchor's hash, equal contents once, and each shard is put in suffix order by external induced
sorting (``suffix_sort``) with queues on disk.  Neighbours in that order with a common prefix
of ``length`` are the repeats.  Every start belongs to one range, so it is judged once.

An anchor that more than ``CROWD`` ranges share is split: its ranges are cut into parts of
``PART_STARTS`` starts by the distance to the anchor, and a part goes by the hash of the bytes that
all its starts hold (length - PART_STARTS + 1 of them), which the contents around a common line
or phrase no longer share.  Texts are known by 128 bits of hash of their content, so copies of
a text are one text; a text that has copies is a repeat in itself.

Defined cases: null is the empty text; texts shorter than ``length`` lose nothing; repeated rows
are copies; matches never cross texts, as no range does.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from voltframe.llm import suffix_sort
from voltframe.llm.common import fields, row_runs, stage, unstage, utf8, with_columns

LENGTH, GRAM = 200, 64
CROWD, PART_STARTS = 4096, 16
SEEN = 200_000
SIDE_BYTES = 24 << 20
SHARD_BYTES = 4 << 20        # a task that sorts a shard takes about 30 times its bytes
LOW = np.uint64((1 << 24) - 1)
TEXT_KEY = ["text_a", "text_b"]


def _ranges(data: np.ndarray, offsets: np.ndarray, length: int, table: np.ndarray):
    """Ranges of starts that share an anchor: row, first start, number of starts, distance from
    the first start to the anchor, hash.  Vectorised over a few texts at once."""
    n = len(data) - length + 1
    if n <= 0:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
    h, by, width = table[data], 0x9E3779B97F4A7C15, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(by) + h[width:]
        by, width = by * by % 2**64, width * 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    least = h & ~LOW | (LOW - np.arange(len(h), dtype=np.uint64))
    window, width = length - GRAM + 1, 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if window > width:
        least = np.minimum(least[:width - window], least[window - width:])
    anchor = (LOW - (least & LOW)).astype(np.int64)
    inside = np.ones(n + length, bool)
    for a, b in zip(np.maximum(offsets[:-1], offsets[1:] - length + 1), offsets[1:]):
        inside[a:b] = False
    starts = np.flatnonzero(inside[:n])
    if not len(starts):
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
    anchor = anchor[starts]
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    row = np.searchsorted(offsets, starts[first], "right") - 1
    return [row, starts[first] - offsets[row], np.diff(np.append(first, len(starts))), anchor[first] - starts[first], h[anchor[first]]]


def _symbol_hashes() -> np.ndarray:
    return np.random.default_rng(23).integers(1, 2**63, 256, dtype=np.uint64)


def _text_ranges(data, offsets, length, table, piece=1 << 21):
    """``_ranges`` of whole texts of any length, a few million bytes at a time."""
    for lo, hi in row_runs(offsets, piece):
        if hi - lo > 1 or offsets[hi] - offsets[lo] <= 2 * piece:
            found = _ranges(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], length, table)
            yield lo + found[0], *found[1:]
            continue
        size = int(offsets[hi] - offsets[lo])
        for at in range(0, size - length + 1, piece):
            part = data[offsets[lo] + at:offsets[lo] + min(size, at + piece + length - 1)]
            found = _ranges(part, np.array([0, len(part)]), length, table)
            yield found[0] + lo, found[1] + at, *found[2:]


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """One row for each range: text key, place (first start, starts and distance packed), hash."""
    def run(batches):
        table = _symbol_hashes()
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, start, count, gap, h in _text_ranges(data, offsets, length, table):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[row]), pa.array(b[row]), pa.array(start << 16 | count << 8 | gap), pa.array(h.view(np.int64))],
                    names=[*TEXT_KEY, "place", "anchor"])

    return docs.mapInArrow(run, "text_a long, text_b long, place long, anchor long")


def _cut(start: int, count: int, gap: int, crowded: bool, length: int):
    """The parts of a range: first start, starts, and the span that all parts of its kind share."""
    if not crowded:
        yield start, count, None
        return
    anchor, end = start + gap, start + count
    while start < end:                                     # by the distance to the anchor
        part = (anchor - start) // PART_STARTS
        stop = min(end, anchor - part * PART_STARTS + 1)
        yield start, stop - start, (anchor - part * PART_STARTS, anchor - (part + 1) * PART_STARTS + 1 + length)
        start = stop


def _contents(listed: DataFrame, length: int) -> DataFrame:
    """One row for each range (or part): text key, start, starts, content key, shard key, and the
    content where this task meets it for the first time."""
    names = [*TEXT_KEY, "start", "starts", "content_a", "content_b", "shard", "content"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def flush(out):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    def run(batches):
        seen = set()
        for batch in batches:
            out = [[] for _ in names]
            for a, b, text, places in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode()
                for p in places:
                    if len(out[0]) > 1 << 14:
                        yield flush(out)
                        out = [[] for _ in names]
                    place, anchor = p["place"], p["anchor"]
                    for start, count, core in _cut(place >> 16, place >> 8 & 255, place & 255, p["crowded"], length):
                        content = raw[start:start + count + length - 1]
                        key = xxhash.xxh3_128_intdigest(content)
                        shard = anchor if core is None else xxhash.xxh64_intdigest(raw[core[0]:core[1]]) - 2**63
                        ab = (key >> 64) - 2**63, (key & (2**64 - 1)) - 2**63
                        new = (ab, shard) not in seen
                        if new:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add((ab, shard))
                        for column, value in zip(out, (a, b, start, count, *ab, shard, content if new else None)):
                            column.append(value)
            yield flush(out)

    return listed.mapInArrow(run, "text_a long, text_b long, start long, starts int, content_a long, content_b long, shard long, content binary")


def _shard_repeats(batches, length: int, room: int):
    """Contents of one shard to the spans of their starts that are repeated within it."""
    keys, counts, known, size = [], [], set(), 1
    with tempfile.TemporaryFile() as file:
        for batch in batches:
            for a, b, count, content in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (a, b) not in known:
                    known.add((a, b))
                    keys.append((a, b))
                    counts.append(count)
                    file.write(content)
                    size += len(content) + 1
        if not keys:
            return
        known.clear()
        counts = np.array(counts, np.int64)
        lens = counts + length - 1
        begins = np.cumsum(lens + 1) - lens - 1
        text = suffix_sort._large(size, np.uint8, None, room)
        file.seek(0)
        for at, n in zip(begins.tolist(), lens.tolist()):
            text[at:at + n] = np.frombuffer(file.read(n), np.uint8) + np.uint8(1)
            text[at + n] = suffix_sort.PART
    text[-1] = suffix_sort.END
    flags = suffix_sort.repeated(text, length, room=room)
    for lo in range(0, len(keys), 4096):
        rows = []
        for (a, b), at, n in zip(keys[lo:lo + 4096], begins[lo:lo + 4096].tolist(), counts[lo:lo + 4096].tolist()):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], flags[at:at + n].astype(np.int8), [0]])))
            if len(edge):
                rows.append({"content_a": a, "content_b": b, "spans": [{"lo": int(x), "hi": int(y)} for x, y in edge.reshape(-1, 2)]})
        spans = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        kind = pa.schema([("content_a", pa.int64()), ("content_b", pa.int64()), ("spans", spans)])
        yield pa.RecordBatch.from_pylist(rows, schema=kind)


def _side(df: DataFrame, listed: str):
    """``df`` to be broadcast if its measured rows and list entries allow, else as it is."""
    n, m = df.agg(F.count("*"), F.sum(F.size(listed))).first()
    return F.broadcast(df) if 64 * n + 40 * (m or 0) <= SIDE_BYTES else df


def repeated_starts(texts: DataFrame, length: int = LENGTH, crowd: int = CROWD, room: int = suffix_sort.ROOM,
                    shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``texts``: text_a, text_b (key of a text's content) and text.  Returns for each key the
    spans of starts whose ``length`` bytes also begin elsewhere among different texts or in the
    text itself; staged."""
    spark = texts.sparkSession
    anchors = stage(_anchors(texts, length), "anchors")
    shared = stage(anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(
        "anchor", (F.col("n") > crowd).alias("crowded")), "shared-anchors")
    hits = anchors.join(shared, "anchor")
    lists = stage(hits.groupBy(*TEXT_KEY).agg(F.collect_set(F.struct("place", "anchor", "crowded")).alias("places")), "places")
    unstage(anchors)
    unstage(shared)
    listed = texts.join(_side(lists, "places"), TEXT_KEY).select(*TEXT_KEY, "text", "places")
    met = Observation()
    parts = stage(_contents(listed, length).observe(met, F.sum(F.octet_length("content")).alias("bytes")), "contents")
    unstage(lists)
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(met.get["bytes"] or 0) // shard_bytes))
    dealt = parts.where("content is not null").select("content_a", "content_b", "starts", "content", "shard")
    dealt = dealt.repartition(shards, "shard").select("content_a", "content_b", "starts", "content")
    sorted_ = stage(dealt.mapInArrow(lambda it: _shard_repeats(it, length, room),
                                     "content_a long, content_b long, spans array<struct<lo:int,hi:int>>"), "repeats")
    found = sorted_.groupBy("content_a", "content_b").agg(F.first("spans").alias("spans"))
    unlike = F.lit(False)
    for c in (*TEXT_KEY, "start"):
        unlike = unlike | (F.min(c) != F.max(c))
    twice = parts.groupBy("content_a", "content_b").agg(unlike.alias("twice"))
    verdict = twice.join(found, ["content_a", "content_b"], "left").where("twice or spans is not null")
    verdict = stage(verdict, "verdicts")
    unstage(sorted_)
    spans = F.when(F.col("twice"), F.array(F.struct(F.lit(0).alias("lo"), F.col("starts").alias("hi")))).otherwise(F.col("spans"))
    there = parts.select(*TEXT_KEY, "start", "starts", "content_a", "content_b").join(verdict, ["content_a", "content_b"])
    there = there.select(*TEXT_KEY, F.explode(F.transform(spans, lambda s: F.struct(
        (F.col("start") + s.lo).alias("lo"), (F.col("start") + s.hi).alias("hi")))).alias("s"))
    out = stage(there.groupBy(*TEXT_KEY).agg(F.collect_set("s").alias("spans")), "repeated-starts")
    unstage(parts)
    unstage(verdict)
    return out


def remove(docs: DataFrame, text_col: str = "text", length: int = LENGTH, drop: tuple[str, ...] = (), digest: bool = False,
           **kw) -> DataFrame:
    """``docs`` plus n_bytes, n_removed, removed (maximal runs of removed bytes) and kept (the
    remaining bytes), or kept_sha256 instead of kept if ``digest``.  Input columns of these
    names, or named text_a, text_b, spans or copied, are not returned."""
    if not GRAM < length < 255:
        raise ValueError(f"length: {length}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = [F.xxhash64(text).alias("text_a"), F.xxhash64(text, F.lit(1)).alias("text_b")]
    enough = F.octet_length(text) >= length
    spans = repeated_starts(docs.where(enough).select(*key, text.alias("text")), length, **kw)
    copies = docs.where(enough).select(*key).groupBy(*TEXT_KEY).agg(F.count("*").alias("n")).where("n > 1")
    known = spans.withColumn("copied", F.lit(False)).unionByName(
        copies.select(*TEXT_KEY, F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), F.lit(True).alias("copied")))
    known = stage(known.groupBy(*TEXT_KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.max("copied").alias("copied")), "known")
    names = [c for c in docs.columns if c.lower() not in ("text_a", "text_b", "spans", "copied")]
    work = docs.select(*names, *key).join(_side(known, "spans"), TEXT_KEY, "left").drop(*TEXT_KEY)
    at, spans_at, copied_at = (work.columns.index(c) for c in (text_col, "spans", "copied"))

    def run(batch):
        sizes, gone, runs, kept = [], [], [], []
        for text, spans, copied in zip(*(batch.column(i).to_pylist() for i in (at, spans_at, copied_at))):
            raw = (text or "").encode()
            cut = [(0, len(raw))] if copied else merged((s["lo"], s["hi"] - 1 + length) for s in spans or ())
            left, last = [], 0
            for a, b in cut:
                left.append(raw[last:a])
                last = b
            left = b"".join([*left, raw[last:]])
            sizes.append(len(raw))
            gone.append(len(raw) - len(left))
            runs.append([{"lo": a, "hi": b} for a, b in cut])
            kept.append(hashlib.sha256(left).hexdigest() if digest else left)
        return [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(runs, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                pa.array(kept, pa.string() if digest else pa.binary())]

    added = fields(n_bytes="bigint", n_removed="bigint", removed="array<struct<lo:bigint,hi:bigint>>",
                   **({"kept_sha256": "string"} if digest else {"kept": "binary"}))
    return with_columns(work, run, added, (*drop, "spans", "copied"))


def merged(spans) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out
