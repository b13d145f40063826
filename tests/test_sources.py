import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from instructspark.fixed_values import RAW_COLUMNS
from instructspark.operators.fields import MissingColumnsError, field_pairs
from instructspark.session import materialize, new_path, remove_path, shared_folder
from instructspark.sources import jsonl, store, tables

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stage_table_roundtrip(spark, raw_rows, tmp_path):
    path = tables.write_stage(raw_rows, str(tmp_path / "stage"))
    assert rows_of(tables.read_stage(spark, path)) == rows_of(raw_rows)
    assert rows_of(tables.load_instructions(spark, path)) == rows_of(raw_rows)
    tables.write_stage(raw_rows.limit(1), path)
    assert tables.read_stage(spark, path).count() == 1


def test_json_instructions(spark, raw_rows, tmp_path):
    jsonl.save_checkpoint(raw_rows, str(tmp_path / "rows"))
    got = tables.load_instructions(spark, str(tmp_path / "rows"), "json")
    assert rows_of(got) == rows_of(raw_rows)


def test_load_needs_a_key(spark, raw_rows, tmp_path):
    path = tables.write_stage(raw_rows.drop("row_id"), str(tmp_path / "raw"))
    with pytest.raises(MissingColumnsError):
        tables.load_instructions(spark, path)


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_ingest_assigns_lasting_unique_keys_in_row_order(spark, raw_rows, tmp_path, format):
    source, target = str(tmp_path / "export"), str(tmp_path / "keyed")
    raw_rows.drop("row_id").coalesce(1).write.option("ignoreNullFields", "false").format(format).save(source)
    keyed = tables.ingest_instructions(spark, source, target, format)
    assert keyed.columns == ["row_id", *RAW_COLUMNS]
    first = rows_of(keyed)
    assert len({row[0] for row in first}) == 5
    assert rows_of(keyed.repartition(3)) == first
    original = [r.instruction for r in raw_rows.orderBy("row_id").collect()]
    assert [r.instruction for r in keyed.orderBy("row_id").collect()] == original


def test_missing_checkpoint_is_empty(spark, tmp_path):
    got = jsonl.load_checkpoint(spark, str(tmp_path / "none"), ROW)
    assert got.count() == 0 and got.schema == ROW


def test_checkpoint_skips_blank_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "text": "æøå"}\n\n   \n{"id": 2, "text": "b"}\n', encoding="utf-8")
    got = jsonl.load_checkpoint(spark, str(tmp_path / "a.json"), ROW)
    assert rows_of(got) == [(1, "æøå"), (2, "b")]


def test_checkpoint_with_a_broken_line_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": 2, "te\n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.load_checkpoint(spark, str(tmp_path / "a.json"), ROW).collect()


def test_checkpoint_appends_plain_utf8(spark, tmp_path):
    path = str(tmp_path / "out")
    jsonl.save_checkpoint(spark.createDataFrame([(1, "blåbær 😀")], ROW), path)
    jsonl.save_checkpoint(spark.createDataFrame([(2, None)], ROW), path)
    assert rows_of(jsonl.load_checkpoint(spark, path, ROW)) == [(1, "blåbær 😀"), (2, None)]
    lines = [line for file in Path(path).glob("*.json") for line in file.read_text("utf-8").splitlines()]
    assert any("blåbær 😀" in line for line in lines)
    assert {"id": 2, "text": None} in [json.loads(line) for line in lines]


def test_other_read_errors_are_not_hidden(spark, tmp_path):
    with pytest.raises(Exception, match="no-such-format"):
        tables.read_or_empty(spark, str(tmp_path), ROW, "no-such-format")


# --- Response store ---------------------------------------------------------


@pytest.fixture
def filled(spark, tmp_path):
    kept = store.ResponseStore(spark, str(tmp_path / "store"))
    schema = "row_id long, field string, response string"
    kept.append(spark.createDataFrame([(1, "a", "one"), (2, "a", "two"), (1, "b", None)], schema), "s")
    kept.append(spark.createDataFrame([(1, "a", "newer"), (2, "a", None)], schema), "s", attempt=2)
    kept.append(spark.createDataFrame([(1, "a", "elsewhere")], schema), "t")
    return kept


def test_store_reads_the_latest_attempt(filled):
    got = {(r.row_id, r.field): (r.response, r.attempt) for r in filled.latest("s").collect()}
    assert got == {(1, "a"): ("newer", 2), (2, "a"): ("two", 1)}
    assert filled.latest("t").first().response == "elsewhere"
    assert filled.latest("none").count() == 0


def test_repeated_appends_do_not_change_the_result(spark, filled):
    before = rows_of(filled.latest("s"))
    filled.append(filled.read("s").where("attempt = 2").drop("attempt"), "s", attempt=2)
    assert filled.read("s").count() == 7
    assert rows_of(filled.latest("s")) == before


def test_store_wide(filled):
    got = {r.row_id: (r.a_response, r.b_response) for r in filled.wide("s", ["a", "b"]).collect()}
    assert got == {1: ("newer", None), 2: ("two", None)}


def test_store_reads_only_its_stage(filled):
    plan = filled.read("s")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stage" in plan


def test_pending_and_attach(spark, filled, raw_rows):
    work = field_pairs(raw_rows, [("instruction", "instruction_en")]).withColumn("field", F.lit("a"))
    assert sorted(r.row_id for r in filled.pending(work, "s").collect()) == [0, 3, 4]
    assert filled.pending(work, "none").count() == 5
    got = {r.row_id: r.response for r in store.attach_responses(work, filled.read("s")).collect()}
    assert got == {0: None, 1: "newer", 2: "two", 3: None, 4: None}


def test_unstored_path_is_an_empty_store(spark, tmp_path):
    kept = store.ResponseStore(spark, str(tmp_path / "nothing"))
    assert kept.read("s").columns == ["row_id", "field", "response", "attempt", "prompt_sha"]
    assert kept.latest("s").count() == 0


def test_shared_folder_is_the_configured_one(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert new_path(spark, "x").startswith(folder + "/x-")
    assert new_path(spark, "x") != new_path(spark, "x")


class FakeSession:
    """A session's settings, as far as the folder needs them."""

    def __init__(self, settings):
        self.conf = settings


def test_shared_folder_of_other_sessions():
    assert shared_folder(FakeSession({"spark.checkpoint.dir": "s3a://b/work/"})) == "s3a://b/work"
    assert shared_folder(FakeSession({"spark.sql.warehouse.dir": "hdfs://w/"})) == "hdfs://w/intermediate"


def test_only_intermediate_tables_are_removed(spark):
    path = new_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_path(spark, path)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path).count()
    with pytest.raises(ValueError, match="not under"):
        remove_path(spark, "/somewhere/else")


def test_materialize_cuts_the_lineage(spark):
    made = materialize(spark.range(5).withColumn("r", F.rand()))
    assert rows_of(made) == rows_of(made)
    assert "Range" not in made._jdf.queryExecution().executedPlan().toString()


def test_many_attempts_of_one_key_combine_before_the_shuffle(spark, raw_rows):
    """One key holds a third of all attempts; it reaches the shuffle as one row per task."""
    attempts = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0, id) as row_id", "'instruction' as field",
        "concat('r', id) as response", "cast(id as int) as attempt")
    got = {r.row_id: r.response for r in store.latest_responses(attempts, store.KEYS).collect()}
    assert len(got) == 2001 and got[0] == "r2997"
    wide = {r.row_id: r.instruction_response for r in store.responses_wide(attempts, ["instruction"]).collect()}
    assert wide == got
    for df in (store.latest_responses(attempts, store.KEYS), store.responses_wide(attempts, ["instruction"])):
        assert "partial_max" in df._jdf.queryExecution().executedPlan().toString()
    work = field_pairs(raw_rows, [("instruction", "instruction_en")])
    left = store.pending(work, attempts)
    assert sorted(r.row_id for r in left.collect()) == [3]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and plan.count("HashAggregate(keys=[row_id") >= 2
