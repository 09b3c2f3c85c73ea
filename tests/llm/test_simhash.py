import numpy as np
import xxhash

from voltframe.llm import simhash


def brute_print(text, size=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            words += [cur] if cur else []
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_classes(rows, bits=4, size=4):
    fps = [brute_print(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(zip([r[0] for r in rows], fps))), key=str)


def test_all_bit_patterns_up_to_four_meet():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 400, dtype=np.uint64)
    for n in range(5):
        other = base.copy()
        for k in range(len(base)):
            for b in rng.choice(64, n, replace=False):
                other[k] ^= np.uint64(1) << np.uint64(b)
        i, a = simhash.anchors_of(base)
        j, b = simhash.anchors_of(other)
        assert (np.bincount(i) <= 32).all()
        mine, theirs = set(zip(i.tolist(), a.tolist())), set(zip(j.tolist(), b.tolist()))
        assert {k for k, _ in mine & theirs} == set(range(len(base)))


ROWS = [(5, "One two three four five six"), (3, "one two THREE four five six"), (9, None), (7, "   "), (8, ""),
        (None, "one two three four five six"), (11, "lone"), (11, "lone"), (12, "Äpfel und Birnen sind Obst\tund gut"),
        (13, "a b c"), (14, "A B C")]


def long_rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for d in range(120):
        base = list(rng.choice(words, 400)) if d % 4 == 0 else rows[-1][1].split()
        if d % 4:
            base[int(rng.integers(len(base)))] = "changed"
        rows.append((100 + d, " ".join(base)))
    return rows


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = simhash.classes(df, keep=("doc_id",), **kw)
    return sorted(((r.doc_id, f"{r.fingerprint & (2**64 - 1):016x}", r.component_id) for r in out.collect()), key=str)


def test_classes_match_brute_force(spark):
    rows = ROWS + long_rows()
    want = brute_classes(rows)
    assert found(spark, rows) == want
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_crowded_anchors_are_dealt_out(spark):
    rng = np.random.default_rng(5)
    fps = [int(x) for x in {(0x1234_5678_9ABC_DEF0 ^ (1 << a) ^ (1 << b)) - 2**63 for a, b in rng.integers(0, 62, (60, 2)).tolist()}]
    df = spark.createDataFrame([(f,) for f in fps], "fingerprint long")
    calm = simhash.components(simhash.links(df)).collect()
    busy = simhash.components(simhash.links(df, crowd=3)).collect()
    assert sorted(calm) == sorted(busy) and len(calm) == len(fps)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_keep_one_with_clashing_columns(spark):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id long, text string, fingerprint string, component_id int")
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.fingerprint) for r in out.collect())) == [(3, "x"), (7, "x"), (11, "x"), (12, "x"), (13, "x")]
