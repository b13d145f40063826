"""The registered queries and the pipeline over the smallest given tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from instructspark.llm.queries import ORACLES, QUERIES
from tools.check_oracles import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    with connect(SF_DIR) as db:
        assert compare(QUERIES[name](spark, SF_DIR), db, name).startswith("same")


@pytest.mark.parametrize(
    "name,columns",
    [
        ("op1_toxicity", {"doc_id", "held_out", "score", "predicted"}),
        ("op5_quality", {"doc_id", "held_out", "score", "predicted"}),
        ("op4_decontamination", {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"}),
        ("op7_token_counts", {"doc_id", "n_tokens", "edited_tokens", "n_recounted"}),
    ],
)
def test_query_has_a_row_for_each_document(spark, name, columns):
    got = QUERIES[name](spark, SF_DIR)
    assert columns <= set(got.columns)
    ids = got.select("doc_id").collect()
    assert sorted(ids) == sorted(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())
    if "score" in columns:
        assert got.where("not (score between 0 and 1)").count() == 0


def test_pipeline_stages(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination", "mixing",
    ]
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, before = given, given.count()
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number < 4:
            assert docs.columns == given.columns
        assert 0 < docs.count() <= before
        before = docs.count()
    assert docs.where("copies < 1 or copies > 2").count() == 0
    # One document of each group of equal texts is left at most.
    assert docs.groupBy("text").count().where("count > 1 and length(text) > 0").count() == 0
    toxic = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1")
    # Eleven toxic documents are few to learn from; some go all the same.
    assert docs.join(toxic, "doc_id").count() < toxic.count()


def test_stages_survive_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b", None, "s", 3), (5, "x " * 9000, "en", None, 18000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for given in (docs, docs.limit(0)):
        out = given
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, out, SF_DIR).select(*corpus_pipeline.COLUMNS)
        assert out.where(F.col("doc_id") == 5).count() == min(1, given.count())
        assert corpus_pipeline.STAGES[4][1](spark, out, SF_DIR).count() <= given.count()


def test_near_duplicate_stage_removes_rows_not_ids(spark):
    a = " ".join(f"alpha{i} beta{i % 7} gamma" for i in range(40))
    b = " ".join(f"clean{i} text{i % 5} here" for i in range(40))
    c = " ".join(f"other{i} words{i % 3} there" for i in range(40))
    rows = [(2, a), (5, a), (5, b), (None, a), (None, c), (None, c), (7, c + " end"), (7, c + " end"),
            (8, None), (8, None), (9, "")]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, SF_DIR).collect()
    got = sorted(((r.doc_id is None, r.doc_id, r.text) for r in kept), key=repr)
    want = sorted([(False, 2, a), (False, 5, b), (False, 7, c + " end"), (False, 8, None), (False, 8, None), (False, 9, "")], key=repr)
    assert got == want


def test_near_duplicate_stage_leaves_texts_where_they_lie(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = [(i, f"{i} " + " ".join(f"w{i % 40}x{k}" for k in range(60)), "en", "a", 9) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.keep_one_of_near_duplicates(spark, spark.read.parquet(path), SF_DIR)
        assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, kept.collect())) == rows[:40]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
