import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from voltframe.llm import bpe, queries


@pytest.fixture(scope="module")
def codec():
    with open(queries.WORD_BPE, encoding="utf-8") as f:
        spec = f.read()
    return bpe.Codec(spec), Tokenizer.from_str(spec)


def texts():
    rng = random.Random(9)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCXYZ0123456789 .,;'!?-_/\n\t" + "éÉßΣςσİıñüÄ日本語한글тестف١٢ﬁ́̈\x1c\x1f\x85\xa0 　\x00\x7f😀"
    out = ["", " ", "Hello, World's 2nd test: don't we'll I'VE", "<|startoftext|> a <|endoftext|>b<|endoftext|>", "<| endoftext |>", "a" * 5000, "é" * 3000,
           "x\x1cy\x1fz", "éä ́x", "ΑΣ ΑΣ. ΣΑΣ", "İstanbul İ"]
    out += [bpe.BLANK.join("ab'sé")] + [f"a{c}b{c}{c}'s" for c in bpe.BLANK]
    out += ["".join(rng.choices(alphabet, k=rng.randint(1, 120))) for _ in range(1500)]
    latin = "abcABC019 '.,s\x00\t" + "".join(map(chr, range(0xA1, 0x100)))
    out += ["".join(rng.choices(latin[:16] + latin[-64:], k=rng.randint(1, 80))) for _ in range(800)] + ["".join(rng.choices(latin, k=rng.randint(1, 80))) for _ in range(800)]
    return out


def test_a_vocabulary_that_joins_in_another_way_is_refused():
    import json
    with open(queries.WORD_BPE, encoding="utf-8") as f:
        spec = json.load(f)
    with pytest.raises(ValueError):
        bpe.Codec(json.dumps(spec | {"normalizer": None}))


def test_ids_and_texts_are_the_librarys(codec):
    mine, library = codec
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        got = np.frombuffer(mine.encode(t), "<u4").tolist()
        assert got == want, repr(t)
        assert mine.decode(mine.encode(t)) == library.decode(want, skip_special_tokens=False)


def test_given_documents(codec, spark):
    mine, library = codec
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    for r in rows:
        assert np.frombuffer(mine.encode(r.text), "<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids


def test_cuts_are_pairs_no_token_holds(codec):
    mine, _ = codec
    tokens = "\n".join(mine._bare(t) for t in mine.vocab)
    for word in ("qzjx" * 3, "thequickbrownfox", "ÃÃÂÂÄÄ"):
        parts = mine.cuts(word)
        assert "".join(parts) == word
        for a, b in zip(parts, parts[1:]):
            assert a[-1] + b[0] not in tokens
    assert len(mine.cuts("qzjx" * 3)) > 3


def test_small_tables_change_nothing(codec):
    mine, library = codec
    old, mine.chunks.size, mine.last.size = (mine.chunks.size, mine.last.size), 3, 3
    try:
        for t in texts()[:300]:
            assert np.frombuffer(mine.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    finally:
        mine.chunks.size, mine.last.size = old


def test_frames(spark, codec):
    _, library = codec
    rows = [(1, "Some text here", "k"), (2, None, None), (3, "", "k"), (None, "Some text here", "k"), (1, "Some text here", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    got = bpe.decode(bpe.encode(df, queries.WORD_BPE), queries.WORD_BPE).collect()
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    n = bpe.digests(df, queries.WORD_BPE, drop=("text",)).collect()
    assert sorted(str((r.doc_id, r.n_tokens)) for r in n) == sorted(str((d, len(library.encode(t or "").ids))) for d, t, _ in rows)
    assert bpe.encode(df.where("false"), queries.WORD_BPE).count() == 0
