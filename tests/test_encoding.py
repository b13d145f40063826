import os
import numpy as np
import pytest
from pyspark.sql import functions as F

from instructspark.operators.fields import MissingColumnsError
from instructspark.operators.scoring import RepeatedPromptsError
from instructspark.operators.encoding import embed
from instructspark.plans.scoring import score_and_rank, score_completions

LETTERS = "abcdefgh"


def letter_encoder():
    """Vectors of letter counts, not normalised."""
    return lambda texts: [[float(text.count(letter)) for letter in LETTERS] for text in texts]


def unit(text):
    counts = np.array([text.count(letter) for letter in LETTERS], dtype=float)
    return counts / (np.linalg.norm(counts) or 1.0)


@pytest.fixture(scope="module")
def tables(spark):
    completions = spark.range(60).selectExpr(
        "id % 6 as prompt_id", "id as completion_id",
        "array(named_struct('role', 'assistant', 'content',"
        " concat(repeat('a', int(id % 5)), repeat('b', int(id % 3)), 'c'))) as completion")
    references = spark.range(6).selectExpr(
        "id as prompt_id", "concat(repeat('a', int(id)), 'bc') as output_improved",
        "if(id % 2 = 0, 'qa', 'creative') as task_type")
    return completions, references


def test_embed_gives_unit_vectors_and_keeps_null(spark):
    df = spark.createDataFrame([("aab",), ("zzz",), (None,)], "t string")
    rows = {r.t: r.v for r in embed(df, "t", "v", letter_encoder).collect()}
    assert rows["aab"] == pytest.approx(list(unit("aab")))
    assert rows["zzz"] == [0.0] * 8 and rows[None] is None
    assert dict(embed(df, "t", "v", letter_encoder).dtypes)["v"] == "array<float>"


def test_scores_from_texts(tables):
    completions, references = tables
    wanted = {r.prompt_id: r.output_improved for r in references.collect()}
    rows = score_completions(completions, references, letter_encoder).collect()
    assert len(rows) == 60
    for row in rows:
        cosine = float(unit(row.completion[0].content) @ unit(wanted[row.prompt_id]))
        assert row.semantic == pytest.approx(min(1.0, max(0.0, (cosine - 0.5) / 0.45)), abs=1e-5)


def test_each_reference_is_embedded_once_and_the_encoder_loaded_once(spark, tables, tmp_path):
    """Both embedding columns share one encoder per worker process."""
    completions, references = tables
    log = tmp_path / "log"

    def counting():
        with log.open("a") as file:
            file.write(f"load {os.getpid()}\n")

        def encode(texts):
            with log.open("a") as file:
                file.write("text\n" * len(texts))
            return [[1.0, 0.0] for _ in texts]

        return encode

    score_completions(completions, references, counting).collect()
    lines = log.read_text().splitlines()
    assert lines.count("text") == 66
    loads = [x for x in lines if x.startswith("load")]
    assert len(loads) == len(set(loads))


def test_score_and_rank(tables, tmp_path):
    completions, references = tables
    ranked = score_and_rank(completions, references, str(tmp_path / "scores"), letter_encoder)
    assert ranked.count() == 60
    sums = ranked.groupBy("prompt_id").agg(F.sum("advantage").alias("s")).collect()
    assert all(abs(r.s) < 1e-9 for r in sums)
    assert ranked.columns == [
        "prompt_id", "completion_id", "task_type", "semantic", "language", "length", "accuracy", "total", "advantage"]


def test_repeated_references_are_refused(spark, tables, tmp_path):
    completions, references = tables
    twice = references.unionByName(references.limit(1))
    with pytest.raises(RepeatedPromptsError, match="2 references"):
        score_and_rank(completions, twice, str(tmp_path / "scores"), letter_encoder)
    assert not (tmp_path / "scores").exists()
    with pytest.raises(MissingColumnsError, match="task_type"):
        score_completions(completions, references.drop("task_type"), letter_encoder)
