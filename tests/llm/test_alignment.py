import hashlib
import random
from collections import Counter

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from voltframe.llm import alignment, queries
from voltframe.llm.bpe import BLANK, byte_letters

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(queries.BYTE_BPE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=queries.PIECE_BPE)
    raw = {c: bytes([i]) for i, c in enumerate(byte_letters())}
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    return a, b, raw, [bytes.fromhex(p[3:5]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def spans(ids, bytes_of):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + len(bytes_of(i))))
        at = out[-1][2]
    return out


def brute(rows, libraries):
    a, b, raw, b_bytes = libraries
    found, corpus = [], Counter()
    for d, text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        a_bytes = {i: b"".join(raw[c] for c in a.id_to_token(i)) for i in x}
        want = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in x) != want or b"".join(b_bytes[i] for i in y) != want:
            found.append((d, [], [], [], []))
            continue
        x, y = spans(x, a_bytes.get), spans(y, b_bytes.__getitem__)
        links = [(i, j) for i, p, q in x for j, r, s in y if p < s and r < q]
        ends = sorted({q for _, _, q in x} & {s for _, _, s in y})
        groups = [(",".join(str(i) for i, _, q in x if p < q <= e), ",".join(str(j) for j, _, s in y if p < s <= e)) for p, e in zip([0, *ends], ends)]
        found.append((d, x, y, links, ["|".join(g) for g in groups]))
        corpus.update(set(links))
    best = {}
    for (i, _), n in corpus.items():
        best[i] = max(best.get(i, 0), n)
    return sorted(((d, len(x), len(y), len(g), len(links), sum(corpus[p] == best[p[0]] for p in links), sum(corpus[p] for p in links), ";".join(g))
                   for d, x, y, links, g in found), key=str), corpus


def texts():
    rng = random.Random(4)
    letters = "abcdefgh ABC 0123 .,;'!?-_\n\t  '" + "éÉßΣ日本語한تي١٢ﬁ́\x1c\x1f\x85\xa0 　▁\x00\x7f😀"
    out = [None, "", " ", "  ", "\n", " \n a", "a ", "a  ", "Hello, World's test: don't  two\n\n three ", "<|endoftext|> a <s> </s> <unk> <0x41>", "x" * 900, "aa" * 40 + " aaa"]
    out += [f"a{c}{c} b{c}c  {c}" for c in BLANK] + [f"a {c}b" for c in BLANK]
    return out + ["".join(rng.choices(letters[:38], k=rng.randint(1, 70))) for _ in range(150)] + ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(150)]


ROWS = [(i, t) for i, t in enumerate(texts())] + [(None, "no id"), (3, "again"), (3, "again")]


@pytest.mark.parametrize("known", [alignment.KNOWN, 40, 0])
def test_documents_and_pairs_against_all_spans(spark, libraries, known):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = alignment.align(docs, queries.BYTE_BPE, queries.PIECE_BPE, known=known)
    want, corpus = brute(ROWS, libraries)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.documents.collect()), key=str) == want
    assert {(r.a, r.b): r.n_docs for r in got.pairs.collect()} == corpus


def test_same_bytes_map_and_given_documents(spark, libraries):
    with open(queries.BYTE_BPE, encoding="utf-8") as f, open(queries.PIECE_BPE, "rb") as g:
        tool = alignment.Aligner(f.read(), g.read())
    pairs = [(i, j) for i, j in enumerate(tool.same) if j >= 0]
    assert len(pairs) > 10_000 and all(tool.a_bytes[i] == tool.b_bytes[j] for i, j in pairs)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1500").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = alignment.align(docs, queries.BYTE_BPE, queries.PIECE_BPE, digest=True).documents
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in brute(rows, libraries)[0]]
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str) == sorted(want, key=str)


def test_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6, "s")], "doc_id int, text string, N_A int, row int, same string")
    got = alignment.align(docs, queries.BYTE_BPE, queries.PIECE_BPE)
    assert got.documents.columns == ["doc_id", "text", "row", "same", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert [(r.row, r.same, r.n_a) for r in got.documents.collect()] == [(6, "s", 2)]
    empty = alignment.align(docs.where("false"), queries.BYTE_BPE, queries.PIECE_BPE)
    assert empty.documents.count() == 0 and empty.pairs.count() == 0
