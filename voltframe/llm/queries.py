"""The registered queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm import (
    alignment,
    bpe,
    conversations,
    decontaminate,
    hilbert_knn,
    langid,
    packing,
    secrets,
    simhash,
    suffix_dedup,
    tokens,
    toxicity,
)
from voltframe.llm.common import table
from voltframe.session import scratch_path

# Where vocabulary files lie; each operator takes a path.
WORD_BPE, BYTE_BPE, PIECE_BPE = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), drop=("text",))
    ids = F.array_join(F.array_sort(F.transform("hit_items", lambda i: i.cast("string"))), ",")
    hit = decontaminate.n_hit()
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_knn.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove(docs, drop=("text",), digest=True)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.classes(docs, keep=("doc_id",))
    return found.select("doc_id", simhash.hex16("fingerprint").alias("fingerprint"), "component_id")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE, drop=("text",))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    return tokens.read(tokens.write(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE, folder), folder)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.histogram(tokens.lengths(table(spark, sf_dir, "documents").select("text"), BYTE_BPE, drop=("text",)))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.held_out("doc_id", 3, 1)
    model = langid.fit(docs, ~out)
    found = langid.identify(docs.select("doc_id", "text"), model, drop=("text",))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    out = langid.held_out("doc_id", 4, 2)
    docs = docs.select("doc_id", "text")
    model = toxicity.fit(docs, labels, ~out)
    found = toxicity.score(docs, model, drop=("text",))
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secrets.scan(docs, keep=("doc_id",))
    def of(kind):
        return F.size(F.filter("secret_spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(of, secrets.KINDS), F.sha2(secrets.named(secrets.KINDS), 256).alias("base_sha256"),
                        secrets.named((*secrets.KINDS, "live")).alias("spans"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.align(docs, BYTE_BPE, PIECE_BPE, digest=True, drop=("text",)).documents
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    found = conversations.digests(conversations.repair(rows, dropped="dropped", times="times", digest=True))
    return found.withColumnRenamed("conv", "conv_id")


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, len(w[i:i+9]) AS n, array_to_string(w[i:i+9], ' ') AS gram
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT rid, w, unnest(generate_series(1, len(w))) AS i FROM d WHERE len(w) > 0),
h AS (SELECT rid, i, g.n, item_id FROM (SELECT rid, i, s.n, array_to_string(w[i:i+s.n-1], ' ') AS gram
        FROM p, (SELECT DISTINCT n FROM g) s WHERE i + s.n - 1 <= len(w)) x JOIN g USING (n, gram)),
hw AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS j FROM h) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT rid, item_id::VARCHAR AS s FROM h) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_neighbours": op2_neighbours,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_language": op6_language,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_secrets": op10_secrets,
    "op11_alignment": op11_alignment,
    "op12_packing": op12_packing,
    "op13_conversations": op13_conversations,
}

ORACLE = {"op1_decontaminate": OP1_SQL}
