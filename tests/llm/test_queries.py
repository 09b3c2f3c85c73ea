"""The registered queries over whole small tables, digest columns included, against plain versions."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from test_alignment import brute as brute_links
from test_alignment import libraries  # noqa: F401  (a fixture)
from test_conversations import brute as brute_repair
from test_hilbert_knn import brute as brute_near
from test_secrets import brute as brute_spans
from test_simhash import brute_classes
from test_suffix_dedup import brute as brute_removed
from tokenizers import Tokenizer

from voltframe.llm import queries

GIVEN = "/root/testdata/sf0.001"
EXTRA = [(9001, None, "en", "s"), (9002, "", None, "s"), (None, "No id, but words.", "en", None), (9003, "  \t ", "de", "x"), (9004, "12 34", "es", "x"),
         (9005, "<|endoftext|> Token=abcdefghijkl12 é", "fr", "s"), (9003, "same id, another text", "en", "x")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    more = spark.createDataFrame([(*r, len(r[1] or "")) for r in EXTRA], docs.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "))
    docs.unionByName(more).repartition(3).write.parquet(f"{folder}/documents.parquet")
    for name in ("embeddings", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{GIVEN}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder, [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def ran(spark, tables, name, *columns):
    out = queries.QUERIES[name](spark, tables[0])
    assert set(columns) <= set(out.columns)
    return sorted((tuple(r[c] for c in columns) for r in out.collect()), key=str)


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_op1(spark, tables):
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tables[0]}/{name}.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE['op1_decontaminate']})").fetchall()
    got = ran(spark, tables, "op1_decontaminate", *columns)
    assert got == sorted(map(tuple, want), key=str) and any(r[5] for r in got)


def test_op2(spark, tables):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{GIVEN}/embeddings.parquet").collect()]
    want = brute_near(rows, lambda q: q % 100 == 0, 10)
    got = {}
    for q, _, v, s in sorted(ran(spark, tables, "op2_neighbours", "query_id", "rank", "vec_id", "score"), key=lambda r: r[:2]):
        got.setdefault(q, []).append((s, v))
    true = {q: {i: s for s, i in brute_near(rows, lambda x, q=q: x == q, len(rows))[q]} for q in want}
    assert got.keys() == want.keys() and all(abs(true[q][v] - s) < 1e-12 for q in got for s, v in got[q])
    assert np.mean([len({v for _, v in got[q]} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9


def test_op3(spark, tables):
    want = [(d, n, gone, runs, sha(kept)) for d, n, gone, runs, kept in brute_removed([r[:2] for r in tables[1]], 200)]
    got = ran(spark, tables, "op3_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(want, key=str) and sum(r[2] > 0 for r in got) > 5


def test_op4(spark, tables):
    assert ran(spark, tables, "op4_simhash", "doc_id", "fingerprint", "component_id") == brute_classes([r[:2] for r in tables[1]])


def test_op5(spark, tables):
    library = Tokenizer.from_file(queries.WORD_BPE)
    want = []
    for d, t, _, _ in tables[1]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert ran(spark, tables, "op5_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)


def held(d, parts, part):
    return d is not None and zlib.crc32(str(d).encode()) % parts == part


def test_op6(spark, tables):
    got = ran(spark, tables, "op6_language", "doc_id", "held_out", "lang_pred", "score")
    assert len(got) == len(tables[1]) and all(h == held(d, 3, 1) and 0 <= s <= 1 for d, h, _, s in got)
    langs = {d: lang for d, t, lang, _ in tables[1] if d is not None and d < 9000}
    tested = [(langs[d], p) for d, h, p, _ in got if h and d in langs]
    assert np.mean([a == b for a, b in tested]) > 0.9 and len(tested) > 30
    assert {p for d, _, p, _ in got if d in (9001, 9002, 9004)} == {"und"}


def test_op7(spark, tables):
    library = Tokenizer.from_file(queries.BYTE_BPE)
    got = sorted(ran(spark, tables, "op7_token_files", "doc_id", "start", "n_tokens", "ids_crc32"), key=lambda r: r[1])
    want = {}
    for d, t, _, _ in tables[1]:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    at, order = 0, [r[0] for r in got]
    for d, start, n, crc in got:
        assert start == at and (n, crc) in want[d]
        want[d].remove((n, crc))
        at += n
    assert order[0] is None and order[1:] == sorted(order[1:]) and not any(want.values())


def test_op8(spark, tables):
    got = ran(spark, tables, "op8_toxicity", "doc_id", "held_out", "score", "predicted")
    assert len(got) == len(tables[1])
    assert all(h == held(d, 4, 2) and 0 <= s <= 1 and p == (s >= 0.3) for d, h, s, p in got)


def test_op9(spark, tables):
    library = Tokenizer.from_file(queries.BYTE_BPE)
    lens = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _, _ in tables[1]]
    got = ran(spark, tables, "op9_token_counts", "context_limit", "n_docs", "total_tokens", "truncated_tokens")
    assert got == sorted(((n, lens.count(n), sum(lens), sum(min(x, n) for x in lens)) for n in set(lens)), key=str)


def test_op10(spark, tables):
    got = ran(spark, tables, "op10_secrets", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    want = []
    for d, t, _, _ in tables[1]:
        base = brute_spans(t)
        want.append((d, *(sum(s.startswith(k) for s in base.split(",")) for k in ("assign", "access", "hex")), sha(base.encode())))
    assert [r[:5] for r in got] == sorted(want, key=str) and any(r[1] for r in got)
    for r in got:
        base = [s for s in r[5].split(",") if s and not s.startswith("live")]
        assert sha(",".join(base).encode()) == r[4]


def test_op11(spark, tables, libraries):  # noqa: F811
    rows = [r[:2] for r in tables[1] if len(r[1] or "") < 1200]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = f"{tables[0]}-short"
    docs.write.parquet(f"{folder}/documents.parquet")
    got = ran(spark, (folder,), "op11_alignment", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = [(*r[:7], sha(r[7].encode()) if r[1] else "") for r in brute_links(rows, libraries)[0]]
    assert got == sorted(want, key=str) and len(got) > 50


def test_op12(spark, tables):
    library = Tokenizer.from_file(queries.BYTE_BPE)
    want = []
    for d, t, _, _ in tables[1]:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        cuts = sorted({0, *range(len(ids), 0, -1024)})
        want += [(d, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert ran(spark, tables, "op12_packing", "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want, key=str)
    room = {}
    for k, at, n in sorted(ran(spark, tables, "op12_packing", "sequence_id", "offset", "length"), key=lambda r: r[:2]):
        assert room.get(k, 0) == at
        room[k] = at + n
    assert max(room.values()) <= 1024 and len(room) <= -(-sum(room.values()) // 1024) + 2


def test_op13(spark, tables):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{GIVEN}/conversations.parquet").collect()]
    got = ran(spark, tables, "op13_conversations", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert got == brute_repair(rows)


def test_every_operator_reads_its_whole_table_without_python_rows(spark):
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    for name in ("op1_decontaminate", "op5_bpe", "op6_language", "op8_toxicity"):
        plan = queries.QUERIES[name](spark, GIVEN)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "Limit" not in plan and "Exchange" not in plan, name


def test_small_columns_have_the_asked_types(spark):
    kinds = {"op2_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
             "op3_suffix_dedup": {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
             "op10_secrets": {"n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
             "op11_alignment": {"n_a": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
             "op12_packing": {"piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
             "op13_conversations": {"gaps": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string"},
             "op8_toxicity": {"held_out": "boolean", "score": "double", "predicted": "int"}}
    for name, want in kinds.items():
        assert want.items() <= dict(queries.QUERIES[name](spark, GIVEN).dtypes).items()
