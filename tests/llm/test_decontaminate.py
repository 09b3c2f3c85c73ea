import random
import re

from pyspark.sql import functions as F

from voltframe.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, bench, size=10):
    windows = {}
    for item, t in bench:
        w = WORD.findall(lowered(t))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for d, t in docs:
        w, hit, items = WORD.findall(lowered(t)), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    items |= ids
        out.append((d, len(w), len(hit), sorted(i for i in items if i is not None)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(4)
    vocab = ["a", "b", "c", "éa", "Ba", "x1"]
    bench = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 9, 10, 14])))) for i in range(8)]
    bench += [(1, bench[1][1]), (None, "null id here"), (20, None), (21, "--"), (22, "solo")]
    docs = []
    for d in range(60):
        t = " ".join(rng.choices(vocab, k=rng.choice([0, 2, 30])))
        if d % 3 == 0:
            t += f", {(rng.choice(bench)[1] or '').upper()}! -- {rng.choice(bench)[1]}"
        docs.append((d, t))
    return docs + [(None, "null id here"), (3, docs[3][1]), (70, None), (71, ""), (72, "SOLO"), (73, "solos")], bench


def test_scan_matches_brute_force_in_one_and_many_blocks(spark):
    docs, bench = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(bench, "item_id long, text string")
    want = brute(docs, bench)
    assert sum(x[2] > 0 for x in want) > 10
    for block in (decontaminate.BLOCK_BYTES, 200):
        got = decontaminate.scan(d, b, block_bytes=block).select("doc_id", "n_words", decontaminate.n_hit().alias("n"), "hit_items")
        assert sorted(((r.doc_id, r.n_words, r.n, r.hit_items) for r in got.collect()), key=str) == want


def test_drop_and_cut(spark):
    d = spark.createDataFrame([(1, "Go, ONE two; three é on", "k"), (2, "clean text", None), (3, None, None)],
                              "doc_id long, text string, N_words string")
    b = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    dropped = decontaminate.decontaminate(d, b)
    assert dropped.columns == d.columns and sorted(r.doc_id for r in dropped.collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(d, b, how="cut").collect()}
    assert cut == {1: "Go,  é on", 2: "clean text", 3: None}


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.hit_items) for r in decontaminate.scan(d, b).collect()] == [(2, [])]
    assert decontaminate.scan(d.where("false"), b).count() == 0


def test_a_long_text_is_scanned_whole(spark):
    text = "w " * 1_500_000 + "one two three"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    r = decontaminate.scan(d, b, drop=("text",)).select("n_words", F.size("hit_items").alias("n")).first()
    assert (r.n_words, r.n) == (1_500_003, 1)
