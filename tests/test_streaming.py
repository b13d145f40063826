from pyspark.sql import functions as F

from instructspark.operators.validate import with_validated
from instructspark.streaming.incremental import incremental_validate


def test_only_new_files_are_validated_and_the_result_equals_batch(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = spark.range(60).selectExpr(
        "id",
        "concat('Dette er tekst nummer ', id) as text",
        "case id % 3 when 0 then 'Kort' when 1 then concat('  Dette er tekst nummer ', id)"
        " else 'her er' || repeat('x', 20) end as response",
    )

    def arrive(low, high):
        rows.where(F.col("id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(source)
        done = incremental_validate(spark, source, rows.schema, target, progress)
        return sorted(done.collect())

    def batch(high):
        return sorted(with_validated(rows.where(F.col("id") < high)).collect())

    assert arrive(0, 20) == batch(20)
    again = incremental_validate(spark, source, rows.schema, target, progress)
    assert again.count() == 20
    assert arrive(20, 60) == batch(60)


def test_files_per_trigger_and_pattern_source(spark, tmp_path):
    rows = spark.range(40).selectExpr("id", "'en to tre fire' as text", "'en to tre fire fem' as response")
    rows.repartition(4).write.parquet(str(tmp_path / "in.parquet"))
    done = incremental_validate(
        spark, str(tmp_path / "in.parque[t]"), rows.schema, str(tmp_path / "out"), str(tmp_path / "progress"),
        finish=lambda df: df.select("id", "reason"), max_files=1)
    assert done.columns == ["id", "reason"]
    assert done.where("reason = 'ok'").count() == 40
