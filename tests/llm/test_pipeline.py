"""The pipeline's stages, each on what its predecessor kept."""

import random

import corpus_pipeline
from adherence.llm import line_dedup, mixing, quality_rules, simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{tmp}/{k}"
        stage(spark, docs, SF).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        if k < 4:
            assert docs.columns == names
        seen[name] = (before, docs)
    before, after = seen["quality_rules"]
    kept = {r["doc_id"] for r in quality_rules.quality_rules(before).filter("kept").collect()}
    assert {r["doc_id"] for r in after.collect()} == kept and 0 < len(kept) < before.count()
    before, after = seen["line_dedup"]
    assert after.count() == before.count()
    want = line_dedup.remove_repeated(before, removed_col="gone").filter("gone > 0").count()
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    assert sum(old[r["doc_id"]] != r["text"] for r in after.collect()) == want
    before, after = seen["simhash_dedup"]
    least = {r["component_id"] for r in simhash.near_dedup(before).collect()}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(least)
    before, after = seen["mix_sources"]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(r["doc_id"] for r in mixing.mix(before).collect())
    before, after = seen["piece_encoding"]
    assert after.count() == before.count() and after.filter("not lossless").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "n_tokens", "lossless"] and out.count() > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_odd_documents_pass_every_stage(spark, tmp):
    """Nulls in every column, empty and long texts, ties, repeated rows and
    columns with the names that stages use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp int, q10_kept int"
    good = "The quiet river turned past the old mill and nobody in the village could say how long the wheel had been still there"
    rnd = random.Random(2)

    def drawn(n):
        return " ".join(rnd.choices(good.split(), k=n))
    rows = [(1, None, None, None, None, None, None, None), (2, "", "en", "a", 0, "x", 1, 1), (None, good + " today", "en", "a", None, "x", 1, 1),
            (3, good, "en", "a", len(good), "x", 1, 1), (3, good, "en", "a", len(good), "x", 1, 1), (4, good, None, None, 1, "y", None, 2),
            (5, drawn(20_000), "en", "b", None, "x", 1, 1)]
    rows += [(10 + i, drawn(24), "en", "c", None, "z", i, i) for i in range(30)]
    docs = spark.createDataFrame(rows, schema)
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp}/{k}")
        docs = spark.read.parquet(f"{tmp}/{k}")
        if k < 4:
            assert docs.columns == names, name
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if k == 0:  # texts without twenty words go; all other texts here are clean
            assert sorted(map(str, ids)) == sorted(map(str, [None, 3, 3, 4, 5, *range(10, 40)]))
        if k == 2:  # one of the equal texts stays
            assert sorted(map(str, ids)) == sorted(map(str, [None, 3, 5, *range(10, 40)]))
    assert docs.filter("not lossless").count() == 0
