"""Each stage of the pipeline, followed by a plain version of its decision on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    from millrace.session import written

    docs, seen = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    leak = F.concat("text", F.lit(' token = "'), F.sha1(F.col("doc_id").cast("string").cast("binary")), F.lit('" end.'))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 10 == 0, leak).otherwise(F.col("text")))
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, FOLDER), name)
        seen.append((name, docs, result))
        docs = result
    return {name: (before, after) for name, before, after in seen}


def ids(df):
    return Counter(r[0] for r in df.select("doc_id").collect())


def test_quality_keeps_what_its_classifier_keeps(spark, stages):
    from millrace.llm.quality_model import fit_quality_model, judge_quality

    before, after = stages["quality"]
    kept = judge_quality(before, fit_quality_model(before)).where("kept")
    assert after.columns == before.columns and ids(after) == ids(kept) and sum(ids(after).values()) > 100
    assert after.exceptAll(before).count() == 0


def test_one_document_of_each_group_stays(stages):
    from test_llm_operators import brute_components

    before, after = stages["near_dedup"]
    want = brute_components([tuple(r) for r in before.select("doc_id", "text").collect()], 5, 80, 100)
    assert ids(after) == Counter(i for i, (_, root) in want.items() if root == i)
    assert after.columns == before.columns and after.exceptAll(before).count() == 0


def test_secrets_go_and_documents_stay(stages):
    before, after = stages["secrets"]
    assert ids(after) == ids(before) and after.columns == before.columns
    found = before.where("text rlike 'token = \"[0-9a-f]{40}\"'").count()
    assert found and after.where("text like '%token = \"[secret]\"%'").count() == found
    assert after.where("text rlike 'token = \"[0-9a-f]{40}\"'").count() == 0
    changed = after.join(before.select("doc_id", F.col("text").alias("old")), "doc_id").where("text <> old")
    assert changed.count() == found and changed.where("n_chars <> char_length(text)").count() == 0


def test_mix_repeats_rows(stages):
    from millrace.llm.mixing import mix

    before, after = stages["mixing"]
    want = {r.doc_id: r.taken // r.size for r in mix(before).collect() if r.taken}
    assert ids(after) == Counter(want) and after.columns == before.columns


def test_packing_covers_every_row(stages):
    before, after = stages["packing"]
    tokens = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("each")).collect()
    copies = ids(before)
    assert {r.doc_id for r in tokens} == set(copies) and all(r.n == r["each"] * copies[r.doc_id] for r in tokens)


def test_no_rows(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, size int")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        assert result.count() == 0 and (name == "packing" or result.columns == docs.columns)


def test_odd_rows_pass(spark):
    import corpus_pipeline

    rows = [(1, "a few plain words of text here", "en", "s", 3), (1, "a few plain words of text here", "en", "s", 3)]
    rows += [(2, None, None, None, None), (3, "", "en", None, 0), (None, "words of a row without id", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(7) for c in ("id", "key", "part", "cut", "kept", "score", "rep", "mark")})
    for name, stage in corpus_pipeline.STAGES:
        docs_after = stage(spark, docs, FOLDER)
        assert docs_after.count() >= 1
        if name != "packing":
            assert docs_after.columns == docs.columns
