"""The compacted response store against the plain one."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from instructspark.sources import versions
from instructspark.sources.compaction import CompactedStore
from instructspark.sources.store import ResponseStore, prompt_digest

ROWS = "row_id long, field string, response string, attempt int, prompt_sha string"


def _attempts(spark):
    sha = lambda text: text  # noqa: E731 - digests are opaque strings here
    first = [(1, "a", "one", 1, sha("p1")), (2, "a", None, 1, None), (3, "a", "three", 1, sha("p3")),
             (3, "b", "three-b", 1, None), (4, "a", "four", 1, sha("p4"))]
    second = [(1, "a", "one again", 2, sha("p1")), (2, "a", "two", 2, sha("p2")), (4, "a", None, 2, None),
              (5, "a", "five", 1, None)]
    return spark.createDataFrame(first, ROWS), spark.createDataFrame(second, ROWS)


def _both(spark, tmp_path):
    plain = ResponseStore(spark, str(tmp_path / "plain"))
    packed = CompactedStore(spark, str(tmp_path / "packed"), buckets=4)
    return plain, packed


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_compaction_keeps_what_reads_see(spark, tmp_path):
    plain, packed = _both(spark, tmp_path)
    first, second = _attempts(spark)
    work = spark.createDataFrame([(i, f) for i in range(1, 7) for f in ("a", "b")], "row_id long, field string")
    for rows in (first, second):
        for store in (plain, packed):
            store.append(rows, "s")
        packed.compact("s")
        assert _same(plain.latest("s"), packed.latest("s"))
        assert _same(plain.pending(work, "s"), packed.pending(work, "s"))
    assert packed._stage_files("s") == []
    assert versions.latest_version(spark, packed._generations("s")) == 2
    # Appends after a compaction are read with the generation.
    late = spark.createDataFrame([(6, "b", "six", 1, None), (1, "a", "newest", 3, None)], ROWS)
    plain.append(late, "s")
    packed.append(late, "s")
    assert _same(plain.latest("s"), packed.latest("s"))
    assert _same(plain.pending(work, "s"), packed.pending(work, "s"))


def test_next_attempt_numbers_survive_the_fold(spark, tmp_path):
    from instructspark.sources.store import with_attempts

    plain, packed = _both(spark, tmp_path)
    first, second = _attempts(spark)
    for store in (plain, packed):
        store.append(first, "s")
        store.append(second, "s")
    packed.compact("s")
    work = spark.createDataFrame([(4, "a", "p4"), (2, "a", "p2")], "row_id long, field string, prompt string")
    assert _same(with_attempts(work, plain.read("s")), with_attempts(work, packed.read("s")))
    assert _same(plain.pending(work, "s"), packed.pending(work, "s"))


def test_pending_after_compaction_shuffles_only_the_work(spark, tmp_path):
    _, packed = _both(spark, tmp_path)
    first, _ = _attempts(spark)
    packed.append(first, "s")
    packed.compact("s")
    work = spark.range(100).select(F.col("id").alias("row_id"), F.lit("a").alias("field"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a store too large to broadcast
    try:
        plan = packed.pending(work, "s")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan


def test_interrupted_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    plain, packed = _both(spark, tmp_path)
    first, second = _attempts(spark)
    for store in (plain, packed):
        store.append(first, "s")
    # The fold is published, then the process dies before the folded files are deleted.
    monkeypatch.setattr(versions._Files, "delete", lambda self, name: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        packed.compact("s")
    monkeypatch.undo()
    assert packed._stage_files("s") and _same(plain.latest("s"), packed.latest("s"))
    for store in (plain, packed):
        store.append(second, "s")
    packed.compact("s")
    assert _same(plain.latest("s"), packed.latest("s"))


def test_a_fold_of_nothing_is_no_generation(spark, tmp_path):
    _, packed = _both(spark, tmp_path)
    assert packed.compact("s") is None
    assert packed.latest("s").count() == 0
    assert prompt_digest(F.lit(None)) is not None
