import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

import model
from instructspark.functions import rewards
from instructspark.operators import scoring
from instructspark.operators.skew import hot_keys, lookup_join


def test_language_reward(evaluate):
    texts = ["", "  　", "plain english words", "Rødgrøt", "æ" + "x" * 199, "æ" + "x" * 99, None, "ÅØÆ"]
    got = evaluate(rewards.language_reward(F.col("t")), "t string", [(t,) for t in texts])
    assert got == [0.0, 0.0, 0.5, 1.0, 0.75, 1.0, 0.0, 1.0]
    assert got == [model.language(t) for t in texts]


def test_language_reward_for_another_alphabet(evaluate):
    column = rewards.language_reward(F.col("t"), "äöü-]", density=0.5)
    assert evaluate(column, "t string", [("aä-]",), ("æøå",)]) == [1.0, 0.5]


@pytest.mark.parametrize(
    ("chars", "score"),
    [(29, 0.0), (30, 0.5), (69, 0.5), (70, 1.0), (150, 1.0), (151, 0.5), (300, 0.5), (301, 0.0)],
)
def test_length_reward_bounds(evaluate, chars, score):
    column = rewards.length_reward(F.col("c"), F.col("r"))
    assert evaluate(column, "c string, r string", [("x" * chars, "y" * 100)]) == [score]


def test_length_reward_edges(evaluate):
    column = rewards.length_reward(F.col("c"), F.col("r"))
    rows = [("a", ""), ("", ""), ("abcd", ""), ("abc", None), (None, "abc"), (" a ", "abc")]
    assert evaluate(column, "c string, r string", rows) == [1.0, 0.0, 0.0, None, 0.0, 1.0]


def test_accuracy_reward(evaluate):
    column = rewards.accuracy_reward(F.col("c"), F.col("r"), F.col("t"))
    rows = [
        (" Nøytral　", "nøytral", "classification", 1.0), ("Elg med gevir", "Elg", "qa", 0.5),
        ("Elg", "elg og rein", "extraction", 0.5), ("Gaupe", "Elg", "qa", 0.0),
        ("Elg", "Elg", "creative", 0.0), ("Elg", "Elg", "generation", 0.0),
        ("", "Elg", "qa", 0.5), ("Elg", "", "qa", 0.5), ("Elg", "Elg", None, 0.0),
        ("Elg", None, "qa", None), (None, "Elg", "qa", 0.5),
    ]
    got = evaluate(column, "c string, r string, t string", [row[:3] for row in rows])
    assert got == [row[3] for row in rows]


def test_random_rewards_match_the_model(evaluate):
    rng = random.Random(5)
    letters = ["a", "B", "æ", "Ø", " ", " ", "\n", "å"]
    tasks = ["qa", "other", "classification", "creative"]
    rows = [
        ("".join(rng.choice(letters) for _ in range(rng.randrange(9))),
         "".join(rng.choice(letters) for _ in range(rng.randrange(4))), rng.choice(tasks))
        for _ in range(1500)
    ]
    schema = "c string, r string, t string"
    got = evaluate(rewards.language_reward(F.col("c")), schema, rows)
    assert got == [model.language(c) for c, _, _ in rows]
    got = evaluate(rewards.length_reward(F.col("c"), F.col("r")), schema, rows)
    assert got == [model.length(c, r) for c, r, _ in rows]
    got = evaluate(rewards.accuracy_reward(F.col("c"), F.col("r"), F.col("t")), schema, rows)
    assert got == [model.accuracy(*row) for row in rows]


def test_semantic_reward(evaluate):
    rows = [
        ([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.725, 0.7]), ([1.0, 0.0], [0.0, 1.0]),
        ([1.0, 0.0], [-1.0, 0.0]), (None, [1.0]), ([1.0], None), ([1.0, 2.0], [1.0]), ([None], [1.0]),
    ]
    schema = "a array<double>, b array<double>"
    got = evaluate(rewards.semantic_reward(F.col("a"), F.col("b")), schema, rows)
    assert got[:4] == [1.0, pytest.approx(0.5), 0.0, 0.0] and got[4:] == [None] * 4
    wide = evaluate(rewards.semantic_reward(F.col("a"), F.col("b"), -1.0, 2.0), schema, rows[:4])
    assert wide == [1.0, pytest.approx(0.8625), 0.5, 0.0]


@pytest.fixture
def paired(spark):
    rows = [
        (0, 0, [("assistant", "Elg")], "Elg", "qa", [1.0, 0.0], [1.0, 0.0]),
        (0, 1, [("assistant", "Gaupe")], "Elg", "qa", [0.0, 1.0], [1.0, 0.0]),
        (1, 2, [("assistant", "En vise på ørten linjer")], "En vise", "creative", [0.6, 0.8], [0.6, 0.8]),
        (1, 3, [], "En vise", "creative", None, [0.6, 0.8]),
    ]
    return spark.createDataFrame(
        rows,
        "prompt_id long, completion_id long, completion array<struct<role:string,content:string>>,"
        " output_improved string, task_type string,"
        " completion_embedding array<double>, reference_embedding array<double>",
    )


def test_score_weights_and_null(paired):
    got = {r.completion_id: r for r in scoring.score(paired).collect()}
    assert (got[0].semantic, got[0].language, got[0].length, got[0].accuracy) == (1.0, 0.5, 1.0, 1.0)
    assert got[0].total == 2.0 * 1.0 + 1.0 * 0.5 + 0.5 * 1.0 + 1.5 * 1.0
    assert got[1].total == 1.0 * 0.5 + 0.5 * 0.5
    assert got[2].semantic == pytest.approx(1.0) and got[2].accuracy == 0.0
    assert got[3].language == 0.0 and got[3].semantic is None and got[3].total is None


def test_default_weights_add_up_to_five():
    assert sum(reward.weight for reward in rewards.DEFAULT_REWARDS) == 5.0


def test_own_rewards_native_and_pandas(paired):
    @F.pandas_udf("double")
    def shouts(text: pd.Series) -> pd.Series:
        return text.fillna("").str.isupper().astype(float)

    own = [
        rewards.Reward("brief", 3.0, lambda completion: (F.length(completion) < 5).cast("double")),
        rewards.Reward("shouts", 1.0, lambda completion: shouts(completion)),
        rewards.Reward("same_id", 1.0, lambda prompt_id, completion_id: (prompt_id == completion_id).cast("double")),
    ]
    got = {r.completion_id: r for r in scoring.score(paired, own).collect()}
    assert (got[0].brief, got[0].shouts, got[0].same_id, got[0].total) == (1.0, 0.0, 1.0, 4.0)
    assert got[1].total == 0.0


def test_string_completions(spark):
    df = spark.createDataFrame([("Elg", "Elg")], "completion string, output_improved string")
    row = scoring.score(df, [rewards.DEFAULT_REWARDS[2]]).first()
    assert row["length"] == 1.0 and row["total"] == 0.5


# --- Groups and skew --------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """One prompt holds a third of 3,000 completions; some have no prompt."""
    prompt = "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 97 end"
    return spark.range(3000).selectExpr(
        f"cast({prompt} as long) as prompt_id", "id as completion_id",
        "cast(id % 13 as double) as total",
    )


def test_hot_keys_are_few_and_salted_by_size(skewed):
    hot = {r.prompt_id: r._salts for r in hot_keys(skewed, "prompt_id", 0.05, 1).collect()}
    assert set(hot) == {7} and hot[7] >= 6
    assert hot_keys(skewed, "prompt_id", 0.05, 100_000).count() == 0


@pytest.mark.parametrize("min_rows", [1, 10**9])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_equals_a_plain_join(spark, skewed, how, min_rows):
    unique = spark.range(60).selectExpr("id as prompt_id", "id * 10 as value")
    got = lookup_join(skewed, unique, "prompt_id", "completion_id", how, 0.01, min_rows)
    plain = skewed.join(unique, "prompt_id", how)
    assert got.columns == plain.columns
    key = lambda r: r.completion_id
    assert sorted(got.collect(), key=key) == sorted(plain.collect(), key=key)


def test_hot_prompt_is_spread_over_tasks(spark, skewed):
    """The join input of a salted prompt does not sit in one partition."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unique = spark.range(100).selectExpr("id as prompt_id", "id as value")
        joined = lookup_join(skewed, unique, "prompt_id", "completion_id", share=0.01, min_rows=1)
        hot = joined.where("prompt_id = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) == 4 and max(r["count"] for r in hot) < 700
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_join_rejects_what_it_cannot_do(skewed):
    with pytest.raises(ValueError):
        lookup_join(skewed, skewed, "prompt_id", "completion_id", "full")
    with pytest.raises(ValueError):
        lookup_join(skewed, skewed, "prompt_id", "completion_id", share=1e-9)


def test_group_advantage(spark):
    rows = [(0, 0, 1.0), (0, 1, 3.0), (1, 2, 5.0), (2, 3, 0.0), (2, 4, 0.0), (2, 5, 3.0)]
    df = spark.createDataFrame(rows, "prompt_id long, completion_id long, total double")
    plain = {r.completion_id: r.advantage for r in scoring.group_advantage(df).collect()}
    assert plain == {0: -1.0, 1: 1.0, 2: 0.0, 3: -1.0, 4: -1.0, 5: 2.0}
    scaled = scoring.group_advantage(df, scale=True, epsilon=0.0001)
    got = {r.completion_id: r.advantage for r in scaled.collect()}
    assert got[1] == pytest.approx(1 / 1.0001) and got[2] == 0.0
    assert got[5] == pytest.approx(2 / (math.sqrt(2) + 0.0001))
    assert scaled.columns == ["prompt_id", "completion_id", "total", "advantage"]


def test_reward_by_task(paired):
    summary = scoring.reward_by_task(scoring.score(paired))
    got = {r.task_type: r for r in summary.collect()}
    assert got["qa"].n == 2 and got["qa"].avg_accuracy == 0.5
    assert got["creative"].n == 2


def test_pair_completions_keeps_every_completion(spark):
    completions = spark.range(40).selectExpr("id % 5 as prompt_id", "id as completion_id")
    references = spark.range(4).selectExpr("id as prompt_id", "'r' as output_improved")
    assert scoring.pair_completions(completions, references).count() == 32
