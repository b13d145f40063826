"""Salvage of checkpoints whose writer died in the middle of a line."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from instructspark.sources.jsonl import TornCheckpointError, salvage_checkpoint, save_checkpoint

SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("response", T.StringType())])


def _write(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")


def test_good_rows_survive_a_torn_last_line(spark, tmp_path):
    folder = tmp_path / "ck"
    save_checkpoint(spark.createDataFrame([(1, "a"), (2, None), (3, "ü\nx")], SCHEMA), str(folder))
    _write(folder, "part-torn.json", '{"row_id": 4, "response": "b"}\n\n{"row_id": 5, "resp')
    found = salvage_checkpoint(spark, str(folder), SCHEMA)
    assert sorted(tuple(r) for r in found.rows.collect()) == [(1, "a"), (2, None), (3, "ü\nx"), (4, "b")]
    assert found.n_broken == 1
    (bad,) = found.broken.collect()
    assert bad.file.endswith("part-torn.json") and bad.line == '{"row_id": 5, "resp'


def test_more_damage_than_the_bound_is_an_error(spark, tmp_path):
    folder = tmp_path / "ck"
    _write(folder, "a.json", '{"row_id": "x", "response": "typed wrong"}\n{"row_id": 1}\nnot json\n')
    with pytest.raises(TornCheckpointError) as raised:
        salvage_checkpoint(spark, str(folder), SCHEMA, most_broken=1)
    assert raised.value.bad == 2
    found = salvage_checkpoint(spark, str(folder), SCHEMA, most_broken=2)
    assert [tuple(r) for r in found.rows.collect()] == [(1, None)]


def test_missing_and_empty_checkpoints(spark, tmp_path):
    found = salvage_checkpoint(spark, str(tmp_path / "none"), SCHEMA)
    assert found.rows.count() == 0 and found.n_broken == 0
    _write(tmp_path / "empty", "a.json", "\n\n")
    found = salvage_checkpoint(spark, str(tmp_path / "empty"), SCHEMA)
    assert found.rows.count() == 0 and found.n_broken == 0
