"""Streaming upsert by key and digest into a bucketed, versioned target."""

from __future__ import annotations

from pyspark.sql import functions as F

from instructspark.sources import versions
from instructspark.streaming.upsert import UpsertTarget, incremental_upsert

SCHEMA = "id long, text string"


def _run(spark, tmp_path, run, rows, calls):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "in" / f"run-{run}"))

    def process(df):
        calls.append(run)
        return df.select("id", "_digest", F.upper("text").alias("result"), F.lit(run).alias("run"))

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    return incremental_upsert(spark, str(tmp_path / "in" / "*"), schema, str(tmp_path / "out"),
                              str(tmp_path / "progress"), "id", process, buckets=4)


def test_three_runs_and_a_replay(spark, tmp_path):
    calls = []
    first = [(i, f"t{i}") for i in range(20)] + [(None, "no key")]
    out = _run(spark, tmp_path, 1, first, calls)
    assert sorted((r.id, r.result, r.run) for r in out.collect()) == [(i, f"T{i}", 1) for i in range(20)]
    second = [(i, f"t{i}" if i % 3 else f"new{i}") for i in range(25)] + [(30, "a"), (30, "b")]
    out = _run(spark, tmp_path, 2, second, calls)
    got = {r.id: (r.result, r.run) for r in out.collect()}
    assert got[3] == ("NEW3", 2) and got[4] == ("T4", 1) and got[22] == ("T22", 2) and got[30] == ("B", 2)
    assert len(got) == 26
    version = versions.latest_version(spark, str(tmp_path / "out"))
    out = _run(spark, tmp_path, 3, second, calls)  # the same rows again: nothing new
    assert {r.id: (r.result, r.run) for r in out.collect()} == got
    target = UpsertTarget(spark, str(tmp_path / "out"), "id", 4)
    target.merge(spark.createDataFrame([(1, "changed")], SCHEMA), 1, ["text"], lambda df: df.limit(0))
    assert versions.latest_version(spark, str(tmp_path / "out")) == version
    assert {r.id: (r.result, r.run) for r in target.read().collect()} == got


def test_only_touched_buckets_are_written(spark, tmp_path):
    target = UpsertTarget(spark, str(tmp_path / "t"), "id", 8)
    process = lambda df: df.select("id", "_digest", "text")
    target.merge(spark.createDataFrame([(i, "x") for i in range(200)], SCHEMA), 0, ["text"], process)
    before = target.folders()
    assert len(before) == 8
    target.merge(spark.createDataFrame([(5, "y")], SCHEMA), 1, ["text"], process)
    after = target.folders()
    assert sum(before[b] != after[b] for b in range(8)) == 1
    assert target.read().count() == 200
    assert target.read().where("id = 5").first().text == "y"
