"""Benchmark decontamination: broadcast sets of normalised test n-grams, scanned over training windows.

Words are runs of digits, letters a-z (A-Z are lowered first) and characters beyond ASCII.  A
window is ``size`` consecutive words of a benchmark item; a shorter item that has words is one
window.  The test grams go to every task as a hash table; a window of a text whose 64-bit hash
is in it is then compared word by word, so no hit rests on a hash.  The table holds at most
``BLOCK_BYTES`` of grams: a larger benchmark is cut into blocks of that size by a hash of its
rows, and each block is one more pass, staged, that adds to the hits found so far; the driver holds two
blocks at once, an executor one.

Defined cases: a null text has no words; null item ids mark words but are not listed; an item
id that comes twice is listed once; an empty benchmark hits nothing; repeated documents each
get their row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import (fields, letters_and_digits, lower_table, row_runs, stage, under_aliases, utf8,
                                  with_columns, word_hashes, word_spans)

SIZE = 10
BLOCK_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RUN = "array<struct<first_word:int,end_word:int,start:int,end:int>>"
MIX = np.uint64(0xD6E8FEB86659FD93)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def grams(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """One row per distinct window and item: gram (words joined by a space), length, item."""
    w = benchmark.select(F.col(item_col).cast("long").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1)))
    w = w.select("item", "w", at.alias("at")).select("item", F.slice("w", F.col("at"), size).alias("w"))
    return w.select("item", F.array_join("w", " ").alias("gram"), F.size("w").alias("n")).distinct()


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, size: int, block_bytes: int):
    """Lists of (gram, number of words, item), each of about ``block_bytes`` at most."""
    g = grams(benchmark, item_col, text_col, size)
    total = g.agg(F.sum(F.octet_length("gram") + 16)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for i in range(n):
        part = g if n == 1 else g.where(F.pmod(F.xxhash64("gram", "n"), F.lit(n)) == i)
        yield [(bytes(r.gram, "utf-8"), r.n, r.item) for r in part.collect()]


def _scanner(table):
    """A function from a batch to (words, runs of hit words, items) of each text.  ``table`` is
    a broadcast of {words in window: {hash: {gram: items}}}."""
    lower, is_word, maps = lower_table(), letters_and_digits(), {}

    def scan(batch, text_at, runs_at, items_at):
        grams_by_n = table.value
        for n, by_hash in grams_by_n.items() if not maps else ():
            maps[n] = np.zeros(1 << 20, bool)
            maps[n][np.fromiter(by_hash, np.uint64, len(by_hash)) >> np.uint64(44)] = True
        data, offsets = utf8(batch.column(text_at))
        old_runs = batch.column(runs_at).to_pylist() if runs_at is not None else None
        old_items = batch.column(items_at).to_pylist() if items_at is not None else None
        counts, all_runs, all_items = [], [], []
        for lo, hi in row_runs(offsets):
            off = offsets[lo:hi + 1] - offsets[lo]
            low = lower[data[offsets[lo]:offsets[hi]]]
            s, e, row = word_spans(low, off, is_word)
            n_words = np.bincount(row, minlength=hi - lo) if len(row) else np.zeros(hi - lo, np.int64)
            first = np.cumsum(n_words) - n_words
            h = word_hashes(low, s, e)
            step = np.zeros(len(s) + 1, np.int32)
            items = [set(old_items[i]) if old_items else set() for i in range(lo, hi)]
            if old_runs:
                for i in range(lo, hi):
                    for r in old_runs[i]:
                        step[first[i - lo] + r["first_word"]] += 1
                        step[first[i - lo] + r["end_word"]] -= 1
            for n, by_hash in grams_by_n.items():
                if len(h) < n:
                    continue
                window = window_hashes(h, n)
                near = np.flatnonzero(maps[n][window >> np.uint64(44)] & (row[:len(window)] == row[n - 1:]))
                for i in near.tolist():
                    if (found := by_hash.get(int(window[i]))) is None:
                        continue
                    gram = b" ".join(low[s[j]:e[j]].tobytes() for j in range(i, i + n))
                    if (ids := found.get(gram)) is not None:
                        step[i] += 1
                        step[i + n] -= 1
                        items[row[i]].update(ids)
            hit = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            runs = [[] for _ in range(hi - lo)]
            if len(hit):
                new = np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(row[hit], prepend=-1) != 0))
                for a, b in zip(hit[new].tolist(), hit[np.append(new[1:], len(hit)) - 1].tolist()):
                    r = int(row[a])
                    runs[r].append({"first_word": a - int(first[r]), "end_word": b + 1 - int(first[r]),
                                    "start": int(s[a] - off[r]), "end": int(e[b] - off[r])})
            counts.append(n_words)
            all_runs += runs
            all_items += [sorted(x) for x in items]
        return np.concatenate(counts), all_runs, all_items

    return scan


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive words from the words' hashes."""
    out = h[:len(h) - n + 1].copy()
    for j in range(1, n):
        out *= MIX
        out += h[j:len(h) - n + 1 + j]
    return out ^ (out >> np.uint64(32))


def _table(rows):
    """{words in window: {hash: {gram: items}}} with the hashes that the scan uses."""
    out: dict = {}
    by_gram: dict = {}
    for gram, n, item in rows:
        by_gram.setdefault((n, gram), set()).update(() if item is None else (item,))
    for (n, gram), items in by_gram.items():
        low = np.frombuffer(gram, np.uint8)
        s, e, _ = word_spans(low, np.array([0, len(low)]), letters_and_digits())
        key = int(window_hashes(word_hashes(low, s, e), n)[0])
        out.setdefault(n, {}).setdefault(key, {})[gram] = sorted(items)
    return out


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES,
         drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus n_words long, hit_runs (maximal runs of hit words: word numbers, byte span)
    and hit_items (ids of items with a window in the text).  Columns in ``drop`` go."""
    spark = docs.sparkSession
    out, added = docs, fields(n_words="bigint", hit_runs=RUN, hit_items="array<bigint>")
    names = {x.lower() for x in added.names}
    out = out.select([c for c in out.columns if c.lower() not in names])
    blocks = _blocks(benchmark, item_col, item_text_col, size, block_bytes)
    rows = next(blocks, None)
    while rows is not None:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(_table(rows))
        work = _scanner(shared)
        cols = out.columns
        at = [cols.index(c) if c in cols else None for c in (text_col, "hit_runs", "hit_items")]

        def run(batch, work=work, at=at):
            n, runs, items = work(batch, *at)
            kinds = _arrow_types()
            return [pa.array(n, pa.int64()), pa.array(runs, kinds[0]), pa.array(items, kinds[1])]

        out = with_columns(out, run, added, drop if following is None else ())
        if following is not None:            # a pass of its own, so no executor holds two blocks
            out = stage(out, "scanned")
            shared.destroy()
        rows = following
    return out


def _arrow_types():
    return (pa.list_(pa.struct([(k, pa.int32()) for k in ("first_word", "end_word", "start", "end")])),
            pa.list_(pa.int64()))


def n_hit() -> Column:
    return F.aggregate("hit_runs", F.lit(0).cast("long"), lambda t, r: t + r.end_word - r.first_word)


def decontaminate(docs: DataFrame, benchmark: DataFrame, how: str = "drop", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without its contamination: ``drop`` takes out documents with a hit word, ``cut``
    takes the bytes from the first to the last word of every hit run out of the text."""
    if how not in ("drop", "cut"):
        raise ValueError(f"how: {how}")
    work, name, back = under_aliases(docs)
    text = name[text_col]
    found = scan(work, benchmark, text, **kw)
    if how == "drop":
        return back(found.where(F.size("hit_runs") == 0))
    raw, size = F.encode(F.col(text), "UTF-8"), F.octet_length(F.col(text))
    ends = F.concat(F.array(F.lit(0)), F.transform("hit_runs", lambda r: r.end))
    starts = F.concat(F.transform("hit_runs", lambda r: r.start), F.array(size))
    kept = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")),
                       lambda p: F.decode(F.substring(raw, p.b + 1, p.a - p.b), "UTF-8"))
    cut = F.when(F.size("hit_runs") > 0, F.array_join(kept, "")).otherwise(F.col(text))
    return back(found.withColumn(text, cut))
