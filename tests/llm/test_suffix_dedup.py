import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.llm import suffix_dedup, suffix_sort


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, _), r in zip(rows, raws):
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone[:-1]])
        out.append((d, len(r), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), kept))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(60)]
    passage = " ".join(rng.choices(vocab, k=60))
    rows = []
    for d in range(150):
        t = " ".join(rng.choices(vocab, k=rng.choice([3, 40, 150])))
        if d % 3 == 0:
            a = rng.randint(0, 60)
            t = f"{t} {passage[a:a + rng.randint(60, 300)]} {' '.join(rng.choices(vocab, k=30))}"
        if d % 5 == 0 and rows:
            t = rows[-1][1][rng.randint(0, 30):] + t
        rows.append((d, t))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, None), (203, ""), (204, "ab" * 300), (205, "x" * 700), (206, "x" * 90), (None, rows[7][1]), (7, rows[7][1]),
             (207, "short"), (208, "short")]
    return rows


@pytest.mark.parametrize("crowd", [4096, 3])
def test_removed_bytes_match_brute_force(spark, crowd):
    rows = corpus()
    for length in (100, 200):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = suffix_dedup.remove(df, length=length, crowd=crowd, room=1 << 12).select(
            "doc_id", "n_bytes", "n_removed", F.size("removed").alias("n"), "kept").collect()
        want = brute(rows, length)
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n, bytes(r.kept)) for r in got), key=str) == want
        assert sum(w[2] > 0 for w in want) > 20 and sum(w[2] == 0 for w in want) > 20


def test_the_number_of_shards_follows_the_bytes_of_contents(spark, monkeypatch):
    rows, dealt = corpus(), []
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kind = type(df)
    monkeypatch.setattr(kind, "repartition", lambda self, n, *by, real=kind.repartition: dealt.append(n) or real(self, n, *by))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for size in (1 << 11, 1 << 30):
        got = suffix_dedup.remove(df, shard_bytes=size).select("doc_id", "n_bytes", "n_removed", F.size("removed").alias("n"), "kept").collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n, bytes(r.kept)) for r in got), key=str) == brute(rows, 200)
    assert dealt[0] > least and dealt[1] == least
    nothing = df.where("doc_id < 0")
    assert suffix_dedup.remove(nothing).count() == 0 and suffix_dedup.remove(df.where("doc_id = 207")).first()["n_removed"] == 0


def test_long_texts_in_pieces_choose_the_same_anchors():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 100, 30_000).astype(np.uint8)
    table, offsets = suffix_dedup._symbol_hashes(), np.array([0, len(text)])

    def starts(piece):
        return sorted((int(s) + i, int(h), int(g) - i) for _, st, c, gap, hs in suffix_dedup._text_ranges(text, offsets, 200, table, piece)
                      for s, n, g, h in zip(st, c, gap, hs) for i in range(n))
    assert starts(1 << 21) == starts(5000) and len(starts(5000)) == 30_000 - 199


@pytest.mark.parametrize("room", [1 << 20, 64])
def test_induced_order_finds_what_repeats(room):
    rng = np.random.default_rng(4)
    for trial in range(150):
        t = rng.integers(1, rng.integers(2, 6), rng.integers(1, 300)).astype(np.uint8)
        if trial % 3 == 0:
            t[rng.integers(0, len(t), 3)] = suffix_sort.PART
        if trial % 4 == 0:
            t = np.tile(t, 3)
        t, cap = np.append(t, np.uint8(0)), int(rng.integers(2, 20))
        raw = t.tobytes()
        seen = Counter(raw[i:i + cap] for i in range(len(raw) - cap + 1))
        want = [i + cap <= len(raw) and seen[raw[i:i + cap]] > 1 for i in range(len(raw))]
        assert (suffix_sort.repeated(t, cap, room=room) == want).all()


def test_queues_go_to_disk():
    q = suffix_sort.Queues(None, 100)
    for i in range(40):
        q.put(i % 3, np.array([i], np.int32), np.array([i], np.uint8))
    assert q.spilled > 0
    for s in range(3):
        assert np.concatenate([p for p, _ in q.newest_first(s)]).tolist() == list(range(s, 40, 3))[::-1]
        assert np.concatenate([p for p, _ in q.take(s)]).tolist() == list(range(s, 40, 3))


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "abc " * 100, "k", 4), (2, None, None, 5)], "doc_id long, text string, kept string, spans int")
    out = suffix_dedup.remove(df)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_removed", "removed", "kept"]
    assert [(r.doc_id, r.n_removed, bytes(r.kept)) for r in out.orderBy("doc_id").collect()] == [(1, 400, b""), (2, 0, b"")]
    assert suffix_dedup.remove(df.where("false")).count() == 0
