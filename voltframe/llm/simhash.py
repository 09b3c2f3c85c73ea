"""SimHash near-duplicates by anchor-point covering.

A fingerprint's 64 bits are cut into two blocks of 31 bits and two spare ones.  If two fingerprints
differ in at most 5 bits, some block differs in at most 2.  In each block the anchors are the
words of the Hamming(31, 26) code: a perfect covering code of radius 1, 2^26 anchors.  Seen from
the point midway between two such blocks the threshold is 1, so each fingerprint goes to every
anchor within covering radius plus threshold, 1 + 1 = 2: the 16 words that its syndrome gives
(1 if it is itself an anchor).  The word nearest the midpoint is among the anchors of both, so
no pair is lost.  Only distinct fingerprints take part: copies cost nothing here.

Per anchor, all members are compared with one another, and only links that join two groups so
far apart are returned (a spanning forest), never all pairs.  An anchor with more than ``CROWD``
members is dealt out: its members are split by hash into chunks, and every two chunks meet
under a key of their own, so no task holds more than two chunks of an anchor.

Defined cases: a null or blank text has fingerprint zero and links like any other; rows repeat
freely; null ids take part, and the id of a component is the smallest that is not null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import (fields, lower_table, not_blank, row_runs, stage, text_key, under_aliases,
                                  unstage, utf8, with_columns, word_runs, word_spans)
from voltframe.llm.components import components

SHINGLE, BITS, SEED = 4, 4, 42
BLOCK, WIDTH = 31, np.uint64((1 << 31) - 1)
CROWD = 20_000
SPARE = 1 << 20


def _fingerprinter(size: int):
    lower, is_word, digest, seed = lower_table(), not_blank(), xxhash.xxh64_intdigest, SEED

    def majority(low, off):
        rows = len(off) - 1
        s, e, row = word_spans(low, off, is_word)
        total, more = np.zeros(rows, np.int64), np.zeros((rows, 64), np.int64)
        if not len(s):
            return np.zeros(rows, np.uint64)
        lens = e - s                                   # the words again, one space after each
        to = np.cumsum(lens + 1) - lens - 1
        flat = np.full(int((lens + 1).sum()), 32, np.uint8)
        for a, b in word_runs(lens):
            n = lens[a:b]
            nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            flat[nth + np.repeat(to[a:b], n)] = low[nth + np.repeat(s[a:b], n)]
        flat, ends = flat.tobytes(), to + lens
        n_words = np.bincount(row, minlength=rows)
        first = np.cumsum(n_words) - n_words
        nth_word = np.arange(len(s)) - first[row]
        last = np.where(n_words[row] < size, np.arange(len(s)) + n_words[row] - 1, np.arange(len(s)) + size - 1)
        begin = np.flatnonzero(nth_word <= np.maximum(0, n_words[row] - size))
        for lo in range(0, len(begin), 1 << 15):
            at = begin[lo:lo + (1 << 15)]
            h = np.array([digest(flat[a:b], seed) for a, b in zip(to[at].tolist(), ends[last[at]].tolist())], "<u8")
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r = row[at]
            cut = np.flatnonzero(np.diff(r, prepend=-1))
            more[r[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
            total[r[cut]] += np.diff(np.append(cut, len(at)))
        set_bits = (2 * more > total[:, None]).astype(np.uint8)
        return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()

    def run(column):
        data, offsets = utf8(column)
        out = [majority(lower[data[offsets[a]:offsets[b]]], offsets[a:b + 1] - offsets[a]) for a, b in row_runs(offsets)]
        return pa.array(np.concatenate(out).view(np.int64), pa.int64())

    return run


def fingerprints(docs: DataFrame, text_col: str = "text", size: int = SHINGLE, out: str = "fingerprint",
                 drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus the signed 64-bit fingerprint of each text."""
    run, at = _fingerprinter(size), docs.columns.index(text_col)
    return with_columns(docs, lambda batch: [run(batch.column(at))], fields(**{out: "bigint"}), drop)


def anchors_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of fingerprint, anchor) for every anchor within distance 2 in either block; an
    anchor is the block's number and the code word."""
    index, anchor = [], []
    for block in (0, 1):
        v = (fps >> np.uint64(BLOCK * block)) & WIDTH
        syndrome = np.zeros(len(v), np.uint64)
        for i in range(BLOCK):
            syndrome ^= np.where(v >> np.uint64(i) & np.uint64(1), np.uint64(i + 1), np.uint64(0))
        one = np.uint64(1)
        whole = syndrome == 0
        nearest = np.where(whole, v, v ^ (one << (np.maximum(syndrome, one) - one)))
        index.append(np.arange(len(v)))
        anchor.append(nearest | np.uint64(block << BLOCK))
        for a in range(1, BLOCK + 1):
            b = syndrome ^ np.uint64(a)
            i = np.flatnonzero(~whole & (b > a))
            index.append(i)
            anchor.append(v[i] ^ np.uint64(1 << (a - 1)) ^ (one << (b[i] - one)) | np.uint64(block << BLOCK))
    return np.concatenate(index), np.concatenate(anchor)


def _near_links(anchor: np.ndarray, fp: np.ndarray, bits: int):
    """Links of a spanning forest among the fingerprints of each anchor; rows lie by anchor."""
    label, gap = np.arange(len(fp)), 1
    left = np.arange(len(fp))
    while len(left):
        left = left[left + gap < len(fp)]
        left = left[anchor[left] == anchor[left + gap]]
        i = left[np.bitwise_count(fp[left] ^ fp[left + gap]) <= bits]
        j = i + gap
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        if len(i):
            yield fp[i], fp[j]
            while True:                                # the two groups get the smaller label
                a, b = label[i], label[j]
                if (a == b).all():
                    break
                np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
                while (label != label[label]).any():
                    label = label[label]
        gap += 1


def _compare(batches, bits: int):
    """Batches of (group, fp) sorted by group to links; a group may span batches."""
    kept_g, kept_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def links(g, f):
        found = list(_near_links(g, f, bits))
        a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        g = np.concatenate([kept_g, batch.column(0).to_numpy()])
        f = np.concatenate([kept_f, batch.column(1).to_numpy().view(np.uint64)])
        cut = int(np.searchsorted(g, g[-1])) if len(g) else 0
        if cut:
            yield links(g[:cut], f[:cut])
        kept_g, kept_f = g[cut:], f[cut:]
    yield links(kept_g, kept_f)


def links(prints: DataFrame, col: str = "fingerprint", bits: int = BITS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints that differ in ``bits`` bits at most: enough
    of them to connect whatever such pairs connect."""
    if not 0 <= bits <= 5:
        raise ValueError("two blocks cover up to 5 differing bits")
    spark = prints.sparkSession

    def cover(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            i, anchor = anchors_of(fps)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(fps[i].view(np.int64))],
                                             names=["anchor", "fp"])

    one = prints.select(col).where(F.col(col).isNotNull()).distinct()
    covered = stage(one.mapInArrow(cover, "anchor long, fp long"), "anchors")
    crowded = stage(covered.groupBy("anchor").count().where(F.col("count") > crowd), "crowded")
    calm = covered
    dealt = None
    if crowded.limit(1).count():
        calm = covered.join(crowded, "anchor", "left_anti")
        busy = covered.join(crowded, "anchor")
        n = F.ceil(F.col("count") / crowd).cast("int") + 1
        own = F.pmod(F.xxhash64("fp"), n).cast("int")
        pairs = busy.withColumn("n", n).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        dealt = pairs.select(F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other")).alias("anchor"), "fp")
    groups = calm.select("anchor", "fp")
    groups = groups if dealt is None else groups.union(dealt)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, "50000")
    try:
        grouped = groups.repartition("anchor").sortWithinPartitions("anchor", "fp")
        out = stage(grouped.mapInArrow(lambda it: _compare(it, bits), "a long, b long").distinct(), "near-links")
    finally:
        spark.conf.set(rows, before)
    unstage(covered)
    unstage(crowded)
    return out


def classes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = SHINGLE, bits: int = BITS,
            keep: tuple[str, ...] | None = None) -> DataFrame:
    """A staged table of ``docs`` (the columns ``keep``, all by default) plus fingerprint,
    near_root (the smallest fingerprint reachable) and component_id (smallest id reachable)."""
    keep = list(keep or [c for c in docs.columns if c.lower() not in ("fingerprint", "near_root", "component_id")])
    work = docs.select(list(dict.fromkeys([*keep, text_col, id_col])))
    prints = stage(fingerprints(work, text_col, size, drop=() if text_col in keep else (text_col,)), "prints")
    return prints.join(_member_table(prints, id_col, bits), "fingerprint")


def _member_table(prints: DataFrame, id_col: str, bits: int) -> DataFrame:
    """fingerprint, near_root and component_id, one row for each distinct fingerprint; staged."""
    one = prints.groupBy("fingerprint").agg(F.min(id_col).alias("least"))
    near = links(prints, bits=bits)
    roots = components(near).select(F.col("node").alias("fingerprint"), "root")
    member = stage(one.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")), "members")
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    member = member.join(ids, "root").select("fingerprint", F.col("root").alias("near_root"), "component_id")
    return stage(member, "classes")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One document of each component: the smallest id (nulls last), then a hash of the row.
    Which rows go is found without the texts, which move once at most."""
    work, name, back = under_aliases(docs)
    row = F.monotonically_increasing_id().alias("near_row")
    prints = stage(fingerprints(work, name[text_col], size).select("*", row), "prints")
    member = _member_table(prints, name[id_col], bits)
    own = F.struct(F.col(name[id_col]).isNull().alias("none"), F.col(name[id_col]).alias("id"), text_key(*work.columns).alias("key"), "near_row")
    rows = prints.select("fingerprint", own.alias("own")).join(member.select("fingerprint", "near_root"), "fingerprint").select("near_root", "own")
    first = rows.groupBy("near_root").agg(F.min("own").alias("first"))
    spare = stage(rows.join(first, "near_root").where("own.near_row <> first.near_row").select("own.near_row"), "spare-rows")
    # numbers of 8 bytes, broadcast only if there are few
    spare = F.broadcast(spare) if spare.count() <= SPARE else spare
    return back(prints.join(spare, "near_row", "left_anti"))


def hex16(fingerprint) -> "F.Column":
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
