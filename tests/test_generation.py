import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from instructspark.operators.fields import field_pairs
from instructspark.operators import generation
from instructspark.plans import chains, distil
from instructspark.plans.improve import improve
from instructspark.plans.prepare import InvalidTableError, check, prepare, prepare_and_publish
from instructspark.plans.resumable import generate_pending, parts_for
from instructspark.sources.store import ResponseStore

SUFFIX = " Fint."


def echo_factory():
    """Answers a rewrite prompt with its last line and a suffix."""
    return lambda prompts: [p.rsplit("\n", 1)[-1] + SUFFIX for p in prompts]


class Tally:
    """A number that worker processes add to; a loaded generator outlives a task's accumulators."""

    def __init__(self, path):
        self.path = path

    def add(self, n):
        with open(self.path, "ab") as file:
            file.write(b"x" * n)

    @property
    def value(self):
        return os.path.getsize(self.path) if os.path.exists(self.path) else 0


def counted(spark):
    """An echo generator that counts prompts, batches and too large batches."""
    folder = tempfile.mkdtemp(prefix="counted-")
    asked, calls, largest = (Tally(f"{folder}/{name}") for name in ("asked", "calls", "largest"))

    def factory():
        def ask(prompts):
            asked.add(len(prompts))
            calls.add(1)
            if len(prompts) > 8:
                largest.add(1)
            return [p.rsplit("\n", 1)[-1] + SUFFIX for p in prompts]

        return ask

    return factory, asked, calls, largest


@pytest.fixture
def kept(spark, tmp_path):
    return ResponseStore(spark, str(tmp_path / "store"))


def many_rows(spark, n=200):
    return spark.range(n).selectExpr(
        "id as row_id", "concat('Tekst nummer ', id, ' om planter') as instruction",
        "if(id % 2 = 0, '', concat('Et tillegg nummer ', id)) as input",
        "concat('Svar nummer ', id, ' til deg') as output",
        "concat('Explain text ', id) as instruction_en", "'' as input_en",
        "concat('Answer ', id) as output_en",
    )


def test_generate_in_batches_and_null_prompts_are_not_asked(spark):
    factory, asked, calls, too_large = counted(spark)
    df = spark.range(0, 100, 1, 4).selectExpr("id", "if(id % 4 = 0, null, concat('p', id)) as prompt")
    rows = generation.generate(df, "prompt", "answer", factory, batch_size=8).collect()
    assert len(rows) == 100
    assert all(r.answer == (None if r.id % 4 == 0 else f"p{r.id}{SUFFIX}") for r in rows)
    assert asked.value == 75 and too_large.value == 0
    assert calls.value >= 10


def test_generator_with_a_wrong_number_of_answers_fails(spark):
    df = spark.range(0, 4, 1, 1).selectExpr("concat('p', id) as prompt")
    with pytest.raises(PySparkException, match="got 1 results for 4 texts"):
        generation.generate(df, "prompt", "x", lambda: lambda prompts: ["one"], 8).collect()


def test_chat_prompts_arrive_as_messages(spark):
    schema = "row_id long, instruction_improved string, input_improved string"
    df = spark.createDataFrame([(1, "Hva?", "Dette")], schema)
    work = distil.answer_work(df, "Svar kort.")

    def factory():
        return lambda chats: [" / ".join(f"{m['role']}: {m['content']}" for m in chat) for chat in chats]

    row = generation.generate(work, "prompt", "answer", factory).first()
    assert row.answer == "system: Svar kort. / user: Hva?\n\nDette"


def test_rewrite_skips_validates_and_falls_back(spark, raw_rows):
    factory, asked, *_ = counted(spark)
    pairs = field_pairs(raw_rows)
    rows = {(r.row_id, r.field): r.result for r in generation.rewrite(pairs, factory).collect()}
    assert len(rows) == 15
    assert rows[0, "instruction"] == "Fortell om hvordan planter vokser." + SUFFIX
    assert rows[0, "input"] == "" and rows[3, "output"] == ""
    assert rows[1, "input"] == "The dog ran home." and rows[2, "output"] == "4"
    to_ask = {r.field: r.to_generate for r in generation.skip_split_counts(pairs).collect()}
    assert to_ask == {"instruction": 4, "input": 1, "output": 3}
    assert asked.value == 8

    useless = generation.rewrite(pairs, lambda: lambda prompts: ["Her er det:"] * len(prompts))
    originals = {(r.row_id, r.field): r.text for r in pairs.collect()}
    assert {(r.row_id, r.field): r.result for r in useless.collect()} == originals


def test_only_the_prompt_goes_to_python(raw_rows):
    plan = generation.rewrite(field_pairs(raw_rows), echo_factory)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [run(CASE WHEN") == 1
    assert "FlatMapGroups" not in plan and "MapInPandas" not in plan


def test_improve_adds_columns_and_keeps_the_rest(raw_rows, kept):
    got = improve(raw_rows, kept, echo_factory)
    assert got.columns == raw_rows.columns + [f"{f}_improved" for f in ("instruction", "input", "output")]
    rows = {r.row_id: r for r in got.collect()}
    assert len(rows) == 5
    assert rows[4].input_improved == "Elg og rein lever i Norge." + SUFFIX
    assert rows[1].input_improved == "The dog ran home."
    assert (rows[3].instruction, rows[3].instruction_improved) == (None, "")


def test_rerun_asks_nothing_and_parts_agree_with_one_job(spark, kept, tmp_path):
    factory, asked, *_ = counted(spark)
    df = many_rows(spark)
    once = sorted(improve(df, kept, factory).collect())
    assert asked.value == 500
    assert sorted(improve(df, kept, factory).collect()) == once
    assert asked.value == 500

    other = ResponseStore(spark, str(tmp_path / "other"))
    assert sorted(improve(df, other, echo_factory, parts=5, parallelism=3).collect()) == once
    assert other.read("improve").count() == 500


def test_crash_loses_at_most_one_part(spark, kept):
    """The generator fails on one text; the parts before it stay, a rerun does the rest."""
    df = many_rows(spark)

    def failing_factory():
        def ask(prompts):
            if any("nummer 77 " in p for p in prompts):
                raise RuntimeError("out of memory")
            return [p.rsplit("\n", 1)[-1] + SUFFIX for p in prompts]

        return ask

    with pytest.raises(PySparkException, match="out of memory"):
        improve(df, kept, failing_factory)
    done = kept.read("improve").count()
    assert 0 <= done < 500 and done == kept.latest("improve").count()

    factory, asked, *_ = counted(spark)
    got = {r.row_id: r for r in improve(df, kept, factory).collect()}
    assert asked.value == 500 - done
    assert kept.read("improve").count() == 500
    assert got[77].output_improved == "Svar nummer 77 til deg" + SUFFIX


def test_parts_with_nothing_left_to_do(spark, kept):
    work = spark.range(6).selectExpr("id as row_id", "'output' as field", "concat('p', id) as prompt")
    for _ in range(2):
        generate_pending(work, kept, "one", echo_factory, parts=3)
    assert kept.read("one").count() == 6
    generate_pending(work.withColumn("prompt", F.lit(None).cast("string")), kept, "two", echo_factory, parts=2)
    assert kept.read("two").count() == 0


def test_pending_skips_what_another_stage_does_not_have(spark, kept):
    work = spark.range(10).selectExpr("id as row_id", "'output' as field", "concat('p', id) as prompt")
    generate_pending(work.where("row_id < 4"), kept, "one", echo_factory)
    generate_pending(work, kept, "one", echo_factory, parts=3)
    generate_pending(work, kept, "two", echo_factory)
    assert kept.read("one").count() == 10 and kept.read("two").count() == 10


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    loads = spark.sparkContext.accumulator(0)

    def factory():
        loads.add(1)
        return lambda prompts: ["x"] * len(prompts)

    df = spark.range(0, 400, 1, 40).selectExpr("concat('p', id) as prompt")
    assert len(generation.generate(df, "prompt", "x", factory).collect()) == 400
    assert 1 <= loads.value <= 8  # 40 tasks on 4 cores


def test_model_is_loaded_once_per_worker_for_all_parts(spark, kept, tmp_path):
    log = tmp_path / "log"

    def factory():
        with log.open("a") as file:
            file.write(f"{os.getpid()}\n")
        return lambda prompts: [p + " Fint." for p in prompts]

    improve(many_rows(spark, 60), kept, factory, parts=6)
    loads = log.read_text().split()
    assert loads and len(loads) == len(set(loads))


def test_responses_belong_to_their_prompt(spark, kept):
    """A changed text or template is asked again and the old response is not taken."""
    pairs = [("instruction", "instruction_en")]
    template = "{reference}|{text}"

    def table(text):
        return spark.createDataFrame(
            [(1, text, "Say it."), (2, "Den andre teksten her.", "Other.")],
            "row_id long, instruction string, instruction_en string",
        )

    def asked():
        rows = kept.read("improve").orderBy("row_id", "attempt").collect()
        return [(r.row_id, r.attempt) for r in rows]

    def factory():
        return lambda prompts: [p.rsplit("|", 1)[-1] + " Ny." for p in prompts]

    improve(table("Den første teksten her."), kept, factory, pairs=pairs, template=template)
    assert asked() == [(1, 1), (2, 1)]
    changed = improve(table("Den endrede teksten her."), kept, factory, pairs=pairs, template=template)
    assert asked() == [(1, 1), (1, 2), (2, 1)]
    got = {r.row_id: r.instruction_improved for r in changed.collect()}
    assert got[1] == "Den endrede teksten her. Ny."
    improve(table("Den endrede teksten her."), kept, factory, pairs=pairs, template="Ny: " + template)
    assert asked() == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]


def test_a_missing_answer_is_asked_again(spark, kept):
    work = spark.createDataFrame([(1, "a", "p"), (2, "a", "q")], "row_id long, field string, prompt string")
    generate_pending(work, kept, "s", lambda: lambda prompts: [p if p == "p" else None for p in prompts])
    generate_pending(work, kept, "s", lambda: lambda prompts: [p + "2" for p in prompts])
    rows = sorted((r.row_id, r.attempt, r.response) for r in kept.read("s").where("response is not null").collect())
    assert rows == [(1, 1, "p"), (2, 2, "q2")]
    assert kept.pending(work, "s").count() == 0


def test_distil_passes(spark, kept):
    df = improve(many_rows(spark, 30), kept, echo_factory)

    def answerer():
        return lambda chats: ["  Et langt svar på " + chat[-1]["content"] for chat in chats]

    answered = distil.distil_generate(df, kept, answerer)
    assert answered.columns == df.columns + ["output_generated"]
    rows = {r.row_id: r.output_generated for r in answered.collect()}
    assert rows[1] == "  Et langt svar på Tekst nummer 1 om planter Fint.\n\nEt tillegg nummer 1 Fint."

    text = "Et langt svar på Tekst nummer"
    polished = distil.distil_polish(answered, kept, lambda: lambda prompts: [text] * len(prompts))
    assert polished.columns == answered.columns + ["output_polished"]
    assert {r.output_polished for r in polished.collect()} == {text}


def test_polish_skips_answers_equal_to_the_english_instruction(spark, kept):
    df = spark.createDataFrame(
        [(0, "Explain it all", " Explain it all "), (1, "Explain it all", "Et svar her"), (2, "x", None)],
        "row_id long, instruction_en string, output_generated string",
    )
    factory, asked, *_ = counted(spark)
    rows = {r.row_id: r.output_polished for r in distil.distil_polish(df, kept, factory).collect()}
    assert asked.value == 1
    assert rows == {0: " Explain it all ", 1: "Et svar her Fint.", 2: ""}


def test_standard_chain(spark, kept, tmp_path):
    prepared, report = chains.standard_chain(many_rows(spark, 40), kept, echo_factory, str(tmp_path), first=25, options=chains.StageOptions(parts=2))
    assert report.total_rows == 25 and report.is_valid
    assert prepared.count() == 25 and prepared.columns[-2:] == ["prompt", "task_type"]


def test_distilled_chain(spark, kept, tmp_path):
    def answerer():
        return lambda chats: ["Et svar på " + chat[-1]["content"] for chat in chats]

    prepared, report = chains.distilled_chain(many_rows(spark, 20), kept, echo_factory, answerer, str(tmp_path))
    assert report.is_valid and report.task_type_distribution == {"qa": 20}
    assert prepared.columns == [
        "row_id", "instruction", "input", "output", "instruction_en", "input_en", "output_en",
        "instruction_improved", "input_improved", "output_improved_phase1", "output_generated",
        "output_improved", "prompt", "task_type",
    ]
    row = prepared.where("row_id = 2").first()
    assert row.output_improved.startswith("Et svar på") and row.output_improved.endswith(SUFFIX)


def test_an_invalid_table_is_not_written(spark, tmp_path):
    df = many_rows(spark, 5).selectExpr(
        "*", "if(row_id = 3, ' ', instruction) as instruction_improved",
        "'' as input_improved", "output as output_improved")
    with pytest.raises(InvalidTableError) as caught:
        prepare_and_publish(df, str(tmp_path / "out"))
    assert caught.value.report.empty_prompts == 1
    assert not (tmp_path / "out").exists()
    assert check(prepare(df.where("row_id <> 3"))).total_rows == 4


def test_parts_for_a_commit_every_so_many_rows():
    assert [parts_for(n, 500, 1) for n in (0, 1, 500, 501, 51942)] == [1, 1, 1, 2, 104]
    assert [parts_for(n, 500) for n in (0, 1, 5, 500, 51942)] == [1, 1, 5, 8, 104]
