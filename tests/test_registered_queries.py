"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

from __spark_entry__ import entry
from instructspark.catalog.oracles import ORACLES
from instructspark.catalog.queries import QUERIES
from tools.check_oracles import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


@pytest.fixture(scope="module")
def db():
    with connect(SF_DIR) as connection:
        yield connection


# Plans that would not hold on a large table: all pairs, a group in one task,
# rows through Python.
UNWANTED = [
    "CartesianProduct", "BroadcastNestedLoopJoin", "Window [", "WindowGroupLimit",
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CollectLimit",
]


# Queries that run a Python generator, or a user's reward function over Arrow batches.
GENERATING = {
    "generate_batches", "improve_generated", "resume_changed_text", "standard_chain",
    "generate_budgeted", "generate_with_failures", "distilled_chain", "group_reward", "embed_rewards",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().toString()
    found = [word for word in UNWANTED if word in plan]
    assert found == [] or (name in GENERATING and found == ["ArrowEvalPython"])
    assert compare(df, db, name).startswith("same")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line for line in plan.split("\n"))


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shuffles_of_the_improved_table(spark, no_broadcast, tmp_path):
    """One shuffle of the table and one of the responses, three fields or not."""
    from instructspark.catalog import given_tables as given
    from instructspark.plans.distil import answers_from_responses, polish_from_responses
    from instructspark.plans.improve import improved_from_responses

    def stored(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    table = stored(given.instruction_table(spark, SF_DIR), "table")
    responses = stored(given.responses(spark, SF_DIR), "responses")
    improved = improved_from_responses(table, responses)
    assert exchanges(improved) == 2

    answers = stored(given.answer_responses(spark, SF_DIR), "answers")
    polish = stored(given.polish_responses(spark, SF_DIR), "polish")
    both = polish_from_responses(answers_from_responses(stored(improved, "improved"), answers), polish)
    assert exchanges(both) == 3


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["language_reward"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = QUERIES["task_distribution"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)" in plan
