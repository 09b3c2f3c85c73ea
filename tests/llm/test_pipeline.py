import corpus_pipeline
from pyspark.sql import functions as F
from test_bpe import codec  # noqa: F401
from test_decontaminate import brute as brute_scan
from test_langid import corpus as language_corpus
from test_simhash import brute_classes

from voltframe.llm.common import stage

SECRET = "9f8e7d6c5b4a39281706aabbccddeeff"


def tables(spark, folder):
    own = [(i, f"{t} {i} {i * 7} x{i}", lang) for i, t, lang in language_corpus(60)]
    rows = [(i, t, lang, f"s{i % 3}") for i, t, lang in own]
    rows += [(100, None, "en", "s1"), (101, "123 456", None, None), (102, rows[4][1], "de", "s2"), (None, rows[5][1], "es", "s2"),
             (103, "the test of one two three four five six seven eight and the shell", "en", "s0"), (104, f"the and thing with token = {SECRET} end", "en", "s1"),
             (4, rows[4][1], "de", "s1"), (105, "", None, "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.char_length("text").cast("long")).withColumn("fingerprint", F.lit("mine"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "One two three four five six, seven EIGHT")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_stages_against_brute_force(spark, tmp_path, codec):  # noqa: F811
    mine, library = codec
    rows = tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = stage(step(spark, docs, str(tmp_path)), f"test-{name}")
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == before.columns
    lettered = [(d, t) for d, t, _, _ in rows if t and any(map(str.isalpha, t))]
    assert sorted(((r.doc_id, r.text) for r in kept["language"]), key=str) == sorted(lettered, key=str)
    classes = brute_classes(lettered)
    assert len(kept["near_copies"]) == len({c for _, _, c in classes})
    assert sorted(r.doc_id for r in kept["near_copies"]) == sorted({c for _, _, c in classes})
    bench = [(1, "One two three four five six, seven EIGHT")]
    clean = [d for d, _, hit, _ in brute_scan([(r.doc_id, r.text) for r in kept["near_copies"]], bench) if not hit]
    assert sorted(r.doc_id for r in kept["benchmark"]) == sorted(clean) and 103 not in clean
    masked = {r.doc_id: r for r in kept["secrets"]}
    assert SECRET not in masked[104].text and masked[104].n_chars == len(masked[104].text)
    assert all(masked[r.doc_id].text == r.text for r in kept["benchmark"] if r.doc_id != 104)
    for r in kept["tokens"]:
        assert r.n_tokens == len(library.encode(masked[r.doc_id].text, add_special_tokens=False).ids)
    assert sorted(r.doc_id for r in kept["tokens"]) == sorted(masked)
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, ran.collect())) == sorted(map(str, kept["tokens"]))


def test_empty_table(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("false")
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, str(tmp_path)), f"empty-{name}")
        assert docs.count() == 0
