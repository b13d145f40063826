"""Dense row numbers in file order under any split size."""

from __future__ import annotations

from pyspark.sql import functions as F

from instructspark.sources.numbering import with_dense_ids
from instructspark.sources.tables import ingest_instructions

SCHEMA = "key long, text string"


def _numbers(spark, path, split):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, str(split))
        return {r.key: r.row_id for r in with_dense_ids(spark.read.schema(SCHEMA).json(path)).collect()}
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_numbers_follow_files_and_lines_whatever_the_splits(spark, tmp_path):
    folder = tmp_path / "export"
    folder.mkdir()
    want, n = {}, 0
    for f in range(4):
        lines = []
        for i in range(250 * (f + 1)):
            key = 10_000 * (3 - f) + i  # keys do not follow the file order
            lines.append(f'{{"key": {key}, "text": "{"x" * (i % 37)}"}}')
            want[key] = n
            n += 1
        (folder / f"part-{f:05d}.json").write_text("\n".join(lines) + "\n")
    for split in (1 << 30, 4096, 1000):
        assert _numbers(spark, str(folder), split) == want


def test_clashing_name_and_empty(spark, tmp_path):
    folder = tmp_path / "e"
    folder.mkdir()
    (folder / "a.json").write_text('{"key": 5, "text": "a"}\n{"key": 6, "text": "b"}\n')
    df = spark.read.schema("key long, text string, row_id long").json(str(folder))
    assert sorted((r.key, r.row_id) for r in with_dense_ids(df).collect()) == [(5, 0), (6, 1)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.json").write_text("")
    assert with_dense_ids(spark.read.schema(SCHEMA).json(str(tmp_path / "none"))).count() == 0


def test_ingest_numbers_densely(spark, tmp_path):
    rows = [(f"i{k}", "", f"o{k}", f"ie{k}", "", f"oe{k}") for k in range(300)]
    cols = "instruction string, input string, output string, instruction_en string, input_en string, output_en string"
    spark.createDataFrame(rows, cols).repartition(3).write.parquet(str(tmp_path / "raw"))
    keyed = ingest_instructions(spark, str(tmp_path / "raw"), str(tmp_path / "keyed"))
    ids = sorted(r.row_id for r in keyed.select("row_id").collect())
    assert ids == list(range(300))
    assert keyed.agg(F.countDistinct("instruction")).first()[0] == 300
