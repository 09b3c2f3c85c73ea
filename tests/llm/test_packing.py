import itertools
import math
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from voltframe.llm import packing, queries


def fewest(items, capacity):
    """Number of bins of a best packing, by trying all."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for b in {r: n for n, r in enumerate(rooms) if r >= items[i]}.values():
            go(i + 1, [r - items[i] * (n == b) for n, r in enumerate(rooms)])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def counted(items):
    return {s: items.count(s) for s in items}


def laid(kinds):
    return sorted(s for kind, times in kinds for _ in range(times) for s in kind)


def test_fixed_sets_are_bins_of_a_best_packing():
    rng, fixed_bins = random.Random(3), 0
    for _ in range(600):
        capacity = rng.choice([10, 20, 37, 50])
        items = [rng.randint(1 if rng.random() < 0.5 else capacity // 4, capacity) for _ in range(rng.randint(1, 9))]
        left = packing.Instance(counted(items), capacity)
        fixed = packing.reduce(left)
        rest = [s for s, n in left.count.items() for _ in range(n)]
        bins = sum(times for _, times in fixed)
        assert sorted(laid(fixed) + rest) == sorted(items) and all(sum(kind) <= capacity for kind, _ in fixed)
        assert bins + fewest(rest, capacity) == fewest(items, capacity)
        fitted = packing.best_fit(left)
        assert laid(fitted) == sorted(rest) and all(sum(kind) <= capacity for kind, _ in fitted)
        fixed_bins += bins
    assert fixed_bins > 500


def test_many_equal_items_are_fixed_at_once():
    fixed, fitted = packing.plan({1000: 10**9, 24: 10**9, 513: 7, 511: 4, 300: 10**8, 3: 10**10})
    assert ((1000, 24), 10**9) in fixed and len(fixed) + len(fitted) < 100
    assert sum(t for k, t in fixed + fitted) <= 1.01 * math.ceil((1024 * 10**9 + 513 * 7 + 511 * 4 + 300 * 10**8 + 3 * 10**10) / 1024)
    with pytest.raises(ValueError):
        packing.plan({1025: 1})


def test_best_fit_takes_the_fullest_bin_with_room():
    left = packing.Instance({6: 1, 7: 1, 3: 1, 4: 1}, 10)
    assert sorted(packing.best_fit(left)) == [((6, 4), 1), ((7, 3), 1)]


ROWS = [(7, "seven words are in this text here"), (3, None), (5, ""), (None, "no id"), (9, "nine " * 700), (7, "another seven"), (7, "another seven"),
        (2, "two é <|endoftext|>"), (4, "a b " * 2000), (None, None)] + [(i, "w " * (i % 37)) for i in range(100, 300)]


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pieces_cover_documents_and_sequences(spark, capacity):
    library = Tokenizer.from_file(queries.BYTE_BPE)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    got = packing.pack(docs, queries.BYTE_BPE, capacity=capacity, with_ids=True)
    rows = [r.asDict() for r in got.collect()]
    want = []
    for d, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        cuts = sorted({0, *range(len(ids), 0, -capacity)})
        want += [(d, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=str) == sorted(want, key=str)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    whole = {r.sequence_id: (r.ids, r.n_pieces) for r in packing.sequences(got).collect()}
    for k, members in by_sequence.items():
        members.sort(key=lambda r: r["offset"])
        lengths = [r["length"] for r in members]
        assert [r["offset"] for r in members] == list(itertools.accumulate([0, *lengths[:-1]])) and sum(lengths) <= capacity
        assert whole[k] == ([i for r in members for i in r["ids"]], len(members))
    least = math.ceil(sum(r["length"] for r in rows) / capacity)
    assert least <= len(by_sequence) <= least + 3 and set(by_sequence) == set(range(len(by_sequence)))


def test_clashing_names_other_id_types_and_empty_tables(spark):
    docs = spark.createDataFrame([("x", "a b c", 1, 2, 3), ("y", None, 4, 5, 6)], "doc_id string, text string, length int, PART int, nth int")
    assert sorted((r.doc_id, r.piece, r.length) for r in packing.pack(docs, queries.BYTE_BPE).collect()) == [("x", 0, 4), ("y", 0, 1)]
    assert packing.pack(docs.where("false"), queries.BYTE_BPE).count() == 0
