import os
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from voltframe.llm import queries, tokens
from voltframe.llm.bpe import BLANK


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.BYTE_BPE)


@pytest.fixture(scope="module")
def encoder():
    with open(queries.BYTE_BPE, encoding="utf-8") as f:
        return tokens.Encoder(f.read())


def texts():
    rng = random.Random(10)
    alphabet = "abcdefghABCXYZ0123456789 .,;'!?-_\n\t'" + "éÉßΣ日本語한تي١٢ﬁ́\x1c\x1f\x85\xa0 　\x00\x7f😀"
    out = ["", " ", "  ", "Hello, World's 2nd test: don't we'll I'VE  two\n\n three ", "<|endoftext|> a <|endoftext|>", "x" * 4000, "!'s ''s '' 'll", " 's"]
    out += [f"a{c}{c} b{c}c  {c}" for c in BLANK] + [f"a {c}b" for c in BLANK]
    latin = "abcÀÖØöøſßéñŠ'’ 0129.,!\n\tªµº²¼×÷\x1d"
    out += ["".join(rng.choices(latin[:-8], k=rng.randint(1, 80))) for _ in range(800)] + ["".join(rng.choices(latin, k=rng.randint(1, 80))) for _ in range(800)]
    return out + ["".join(rng.choices(alphabet, k=rng.randint(1, 120))) for _ in range(1500)]


def test_pieces_give_the_librarys_ids(encoder, library):
    all_texts = texts()
    for t, got in zip(all_texts, encoder.encode(all_texts)):
        assert np.frombuffer(got, encoder.width).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_small_tables_change_nothing(encoder, library):
    old, encoder.words.size, encoder.pieces.size = (encoder.words.size, encoder.pieces.size), 5, 5
    try:
        for t in texts()[:300]:
            assert np.frombuffer(encoder.encode([t])[0], encoder.width).tolist() == library.encode(t, add_special_tokens=False).ids
    finally:
        encoder.words.size, encoder.pieces.size = old


ROWS = [(7, "seven words are in this text here"), (3, None), (5, ""), (None, "no id"), (9, "nine"), (7, "another seven"), (2, "two é"), (-4, "minus four"), (7, "another seven")]


def test_files_round_trip(spark, library, tmp_path):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    folder = f"file://{tmp_path}/out"
    shards = tokens.write(df, queries.BYTE_BPE, folder)
    got = sorted(tokens.read(shards, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -4, 2, 3, 5, 7, 7, 7, 9]
    at = 0
    for r in got:
        options = [library.encode(t or "", add_special_tokens=False).ids + [2] for d, t in ROWS if d == r.doc_id]
        ids = [o for o in options if len(o) == r.n_tokens and zlib.crc32(np.array(o, "<u4").tobytes()) == r.ids_crc32]
        assert ids and r.start == at
        at += r.n_tokens
    assert sum(os.path.getsize(tmp_path / "out" / f) for f in os.listdir(tmp_path / "out") if f.endswith(".bin")) == 2 * at
    assert not [f for f in os.listdir(tmp_path / "out") if f.startswith(".shard") and not f.endswith(".crc")]
    assert [tuple(r) for r in sorted(tokens.read(tokens.write(df, queries.BYTE_BPE, folder), folder).collect(), key=lambda r: r.start)] == [tuple(r) for r in got]


def test_a_hot_id_spans_several_shards(spark, library, tmp_path):
    rows = [(5, "same text")] * 900 + [(None, f"text {i}") for i in range(900)] + [(i, "x") for i in range(10)]
    folder = f"file://{tmp_path}/out"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")        # small partitions are not put together
    try:
        shards = tokens.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), queries.BYTE_BPE, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r.docs for r in shards.collect()) < 700
    got = sorted(tokens.read(shards, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 900 + sorted(d for d, _ in rows if d is not None)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


def test_a_vocabulary_of_another_split_is_refused():
    import json
    with open(queries.BYTE_BPE, encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError):
        tokens.Encoder(json.dumps(spec))


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder = f"file://{tmp_path}/out"
    assert tokens.read(tokens.write(df, queries.BYTE_BPE, folder), folder).count() == 0
    assert tokens.histogram(tokens.lengths(df, queries.BYTE_BPE)).count() == 0


def test_histogram_answers_every_limit(spark):
    rng = random.Random(1)
    lens = [int(rng.paretovariate(0.7)) % 5000 for _ in range(800)] + [0, 0, 4999]
    df = spark.createDataFrame([(n,) for n in lens] + [(None,)], "n_tokens long")
    hist = tokens.histogram(df, block=64)
    rows = hist.collect()
    assert len(rows) == len(set(lens))
    for r in rows:
        limit = r.context_limit
        assert (r.n_docs, r.docs_at_least, r.docs_at_most) == (lens.count(limit), sum(n >= limit for n in lens), sum(n <= limit for n in lens))
        assert r.truncated_tokens == sum(min(n, limit) for n in lens) and r.total_tokens == sum(lens)
        assert abs(r.share - r.docs_at_most / len(lens)) < 1e-12
    q = {r.q: r.n_tokens for r in tokens.quantiles(hist, [0.5, 0.9, 1.0]).collect()}
    ordered = sorted(lens)
    assert q == {x: ordered[int(np.ceil(x * len(lens))) - 1] for x in (0.5, 0.9, 1.0)}


def test_limits_that_are_nobodys_length(spark):
    rng = random.Random(3)
    lens = [rng.randint(5, 900) * 3 for _ in range(200)]
    hist = tokens.histogram(spark.createDataFrame([(n,) for n in lens], "n_tokens long"))
    limits = [0, 1, 14, 15, 16, 400, 401, 2700, 10_000]
    got = {r.context_limit: tuple(r)[1:] for r in tokens.at_limits(hist, limits).collect()}
    assert got == {x: (sum(n <= x for n in lens), sum(n > x for n in lens), sum(lens), sum(min(n, x) for n in lens)) for x in limits}
    assert tokens.at_limits(hist.where("false"), limits).count() == 0


def test_lengths_of_whole_texts(spark, library):
    df = spark.createDataFrame([(1, "abc def " * 100_000, 5), (2, None, 6)], "doc_id long, text string, N_TOKENS int")
    got = {r.doc_id: r.n_tokens for r in tokens.lengths(df, queries.BYTE_BPE).collect()}
    assert got == {1: len(library.encode("abc def " * 100_000).ids), 2: 0}
