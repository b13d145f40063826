import pytest
from pyspark.sql import functions as F

from instructspark.operators import fields, reports
from instructspark.plans.prepare import prepare

PROMPT = "prompt array<struct<role:string,content:string>>"


def test_field_pairs(raw_rows):
    got = fields.field_pairs(raw_rows)
    assert got.columns == ["row_id", "field", "text", "ref_text"]
    rows = {(r.row_id, r.field): (r.text, r.ref_text) for r in got.collect()}
    assert len(rows) == 15
    assert rows[3, "output"] == ("", "")
    assert rows[1, "input"] == ("The dog ran home.", "The dog ran home.")


def test_gather_fields_keeps_rows_and_columns(raw_rows):
    results = fields.field_pairs(raw_rows).where("row_id <> 2").withColumn("v", F.upper("text"))
    got = fields.gather_fields(raw_rows, results, "v")
    assert got.columns == raw_rows.columns + [f"{f}_improved" for f in ("instruction", "input", "output")]
    rows = {r.row_id: r for r in got.collect()}
    assert len(rows) == 5
    assert rows[0].output_improved == "PLANTER BRUKER LYS TIL Å VOKSE."
    assert rows[2].output_improved is None and rows[2].output == "4"


def test_required_columns_fail_before_a_job(raw_rows):
    assert fields.require_columns(raw_rows, ["row_id", "output"]) is raw_rows
    with pytest.raises(fields.MissingColumnsError) as caught:
        fields.require_columns(raw_rows)
    assert caught.value.missing == ["instruction_improved", "input_improved", "output_improved"]


def test_swap_reference(spark):
    df = spark.createDataFrame([("old", "new")], "output_improved string, output_polished string")
    row = fields.swap_reference(df).first().asDict()
    assert row == {"output_improved_phase1": "old", "output_improved": "new"}
    row = fields.swap_reference(df.drop("output_improved")).first().asDict()
    assert row == {"output_improved": "new"}
    with pytest.raises(fields.MissingColumnsError):
        fields.swap_reference(df.drop("output_polished"))


def test_first_rows_and_preview(raw_rows):
    first = fields.first_rows(raw_rows.orderBy(F.desc("row_id")), 3)
    assert sorted(r.row_id for r in first.collect()) == [0, 1, 2]
    assert fields.first_rows(raw_rows.limit(0), 3).count() == 0
    assert fields.first_rows(raw_rows, 99).count() == 5
    got = fields.preview(raw_rows, ["output"], n=2, width=7).orderBy("row_id").collect()
    assert [(r.row_id, r.output) for r in got] == [(0, "Planter"), (1, "Hunden ")]
    got = fields.preview(raw_rows, {"output": 3, "instruction": 5}, n=1).first()
    assert (got.output, got.instruction) == ("Pla", "Forte")


@pytest.fixture(scope="module")
def prepared(spark):
    rows = [(i, f"Oppgave {i}", "", "svar", text) for i, text in enumerate(
        ["Explain it", "Why so", "Write it", "Go on", None, "Explain again"])]
    df = spark.createDataFrame(
        rows, "row_id long, instruction_improved string, input_improved string,"
        " output_improved string, instruction_en string")
    return prepare(df)


def test_prepare_keeps_columns(prepared):
    assert prepared.columns[-2:] == ["prompt", "task_type"] and len(prepared.columns) == 7
    first = prepared.where("row_id = 0").first()
    assert first.task_type == "qa" and first.prompt[0].content == "Oppgave 0"


def test_prepare_of_an_incomplete_table(spark):
    row = prepare(spark.createDataFrame([(1,)], "row_id long")).first()
    assert row.task_type == "other" and row.prompt[0].content == ""


def test_distribution(prepared):
    rows = [(r.task_type, r.n) for r in reports.task_distribution(prepared).collect()]
    assert rows == [("qa", 3), ("other", 2), ("generation", 1)]
    shares = [(r.task_type, r.pct) for r in reports.task_distribution_pct(prepared).collect()]
    assert shares == [("qa", 50.0), ("other", 200 / 6), ("generation", 100 / 6)]


def test_sample_per_task_is_the_first_row(prepared):
    rows = {r.task_type: (r.row_id, r["sample"]) for r in reports.sample_per_task(prepared, 7).collect()}
    assert rows == {"qa": (0, "Oppgave"), "generation": (2, "Oppgave"), "other": (3, "Oppgave")}


def test_valid_report(prepared):
    row = reports.validation_report(prepared).first().asDict()
    assert row == {
        "total_rows": 6, "empty_prompts": 0, "missing_columns": [], "is_valid": True,
        "task_type_distribution": {"qa": 3, "other": 2, "generation": 1},
    }


def test_report_finds_empty_prompts_and_null_labels(spark):
    rows = [
        ([("user", "")], "other"), ([("user", " 　")], "qa"), ([], "qa"), (None, None),
        ([("user", None)], "qa"), ([("user", "x")], "qa"),
    ]
    df = spark.createDataFrame(rows, PROMPT + ", task_type string").selectExpr(
        "*", "'a' as output_improved", "'b' as instruction_improved", "'c' as instruction_en")
    row = reports.validation_report(df).first()
    assert (row.total_rows, row.empty_prompts, row.is_valid) == (6, 5, False)
    assert row.task_type_distribution == {"other": 2, "qa": 4}


def test_report_without_required_columns(spark):
    row = reports.validation_report(spark.createDataFrame([(1,), (2,)], "x int")).first()
    assert row.missing_columns == [
        "prompt", "task_type", "output_improved", "instruction_improved", "instruction_en"]
    assert (row.total_rows, row.empty_prompts, row.is_valid) == (2, 2, False)
    assert row.task_type_distribution == {"other": 2}


def test_report_of_an_empty_table(prepared):
    row = reports.validation_report(prepared.where("false")).first()
    assert (row.total_rows, row.empty_prompts, row.is_valid) == (0, 0, True)
    assert row.task_type_distribution == {}


def test_change_stats(spark):
    rows = [("a", "b", None, None), ("a", "a", None, "x"), (None, "a", "y", "y"), ("a", "A", "z", "z")]
    df = spark.createDataFrame(rows, "u string, u_new string, w string, w_new string")
    got = {r.field: r for r in reports.change_stats(df, ["u", "w"], "_new").collect()}
    assert (got["u"].changed, got["u"].total, got["u"].pct) == (3, 4, 75.0)
    assert (got["w"].changed, got["w"].pct) == (1, 25.0)
    one = reports.change_rate(df, "u", "u_new").first()
    assert (one.changed, one.total, one.pct) == (3, 4, 75.0)
    none = reports.change_rate(df.where("false"), "u", "u_new").first()
    assert (none.changed, none.total, none.pct) == (0, 0, 0.0)
