"""The registered queries: one per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from instructspark.catalog import given_tables as given
from instructspark.functions.classification import task_type
from instructspark.functions.predicates import should_skip
from instructspark.functions.prompts import (
    SYSTEM_MESSAGE,
    chat_prompt,
    first_content,
    rewrite_prompt,
)
from instructspark.functions.rewards import (
    DEFAULT_REWARDS,
    Reward,
    accuracy_reward,
    language_reward,
    length_reward,
    semantic_reward,
)
from instructspark.functions.text import strip, word_overlap
from instructspark.functions.validation import has_marker_prefix, usable_line, validate_response
from instructspark.operators import reports, scoring
from instructspark.operators.fields import (
    field_pairs,
    first_rows,
    gather_fields,
    preview,
    swap_reference,
)
from instructspark.operators.budgeted import generate_budgeted as generate_by_budget
from instructspark.operators.group_rewards import AGREEMENT, group_reward
from instructspark.operators.generation import accepted_text, rewrite, with_rewrite_prompt
from instructspark.operators.generation import skip_split_counts as count_skips
from instructspark.operators.validate import reason_counts, with_validated
from instructspark.plans import chains
from instructspark.plans.distil import answers_from_responses, polish_from_responses
from instructspark.plans.improve import improve, improved_from_responses
from instructspark.plans.prepare import prepare, prepare_distilled
from instructspark.plans.scoring import score_completions
from instructspark.plans.prepare import publish_observed as publish_checked
from instructspark.plans.resumable import generate_pending
from instructspark.session import materialize, new_path
from instructspark.sources import jsonl, store, tables, versions
from instructspark.sources.compaction import CompactedStore
from instructspark.sources.numbering import with_dense_ids
from instructspark.streaming.incremental import incremental_validate as validate_new_files
from instructspark.streaming.upsert import UpsertTarget
from instructspark.streaming.upsert import incremental_upsert as upsert_files

Query = Callable[[SparkSession, str], DataFrame]

# Letters of the other languages in the given documents, and a density at which
# their reward does not saturate.
DOCUMENT_ALPHABET = "äöüßÄÖÜéèêçàôî"
DOCUMENT_DENSITY = 0.2

# A scale that fits the given vectors, whose similarities lie around zero.
WIDE_FLOOR = -0.3
WIDE_SPAN = 0.6


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return field_pairs(given.instruction_table(spark, sf_dir))


def _answered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.attach_responses(_pairs(spark, sf_dir), given.responses(spark, sf_dir))


def _improved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return improved_from_responses(
        given.instruction_table(spark, sf_dir), given.responses(spark, sf_dir)
    )


def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers_from_responses(_improved(spark, sf_dir), given.answer_responses(spark, sf_dir))


def _polished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polish_from_responses(_generated(spark, sf_dir), given.polish_responses(spark, sf_dir))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(_improved(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared straight from the source columns, for the reports on labels."""
    return prepare(given.instruction_table(spark, sf_dir), "instruction", "input")


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.pair_completions(
        given.completions(spark, sf_dir), given.references(spark, sf_dir)
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four rewards; a completion of the first answer gets its reference's vector."""
    references = given.with_vectors(
        given.references(spark, sf_dir), F.col("prompt_id") * 3, "reference_embedding", sf_dir
    )
    paired = scoring.pair_completions(given.completions(spark, sf_dir), references)
    turn = F.col("completion_id") - F.col("prompt_id") * given.TURN_SPACE
    own = F.col("prompt_id") * 3 + turn - 1
    scored = scoring.score(given.with_vectors(paired, own, "completion_embedding", sf_dir))
    return scored.select(
        "prompt_id", "completion_id", "task_type", *[r.name for r in DEFAULT_REWARDS], "total"
    )


def _flat_prompt(df: DataFrame) -> DataFrame:
    """The message list as columns, so that SQL engines can compare it."""
    return df.select(
        *[c for c in df.columns if c != "prompt"],
        F.size("prompt").alias("messages"),
        F.get("prompt", F.lit(0)).getField("role").alias("role"),
        F.get("prompt", F.lit(0)).getField("content").alias("content"),
    )


# --- Sources and sinks -----------------------------------------------------


def instruction_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "instructions")
    tables.write_stage(given.instruction_table(spark, sf_dir), path)
    return tables.load_instructions(spark, path)


def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "stage")
    tables.write_stage(_improved(spark, sf_dir), path)
    return tables.read_stage(spark, path)


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "jsonl")
    tables.write_stage(given.instruction_table(spark, sf_dir), path + "-parquet")
    table = tables.load_instructions(spark, path + "-parquet")
    jsonl.save_checkpoint(table, path)
    return tables.load_instructions(spark, path, "json")


def checkpoint_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends of different rows, then everything read back."""
    path = new_path(spark, "checkpoint")
    rows = given.responses(spark, sf_dir).select("row_id", "field", "response", "attempt")
    for attempt in (1, 2):
        jsonl.save_checkpoint(rows.where(F.col("attempt") == attempt), path)
    return jsonl.load_checkpoint(spark, path, rows.schema)


def store_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store filled attempt by attempt with a compaction after each, read as latest."""
    kept = CompactedStore(spark, new_path(spark, "compacted"))
    rows = materialize(given.responses(spark, sf_dir), "attempts")
    for attempt in (1, 2):
        kept.append(rows.where(F.col("attempt") == attempt), "improve", attempt)
        kept.compact("improve")
    return kept.latest("improve")


def ingest_dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export in several JSON files gets row numbers in file order, twice: with the
    session's split size and with splits of a few kilobytes; both must agree."""
    path = new_path(spark, "export")
    table = given.instruction_table(spark, sf_dir).select(F.col("row_id").alias("source_id"), "instruction")
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table.repartitionByRange(parts, "source_id").sortWithinPartitions("source_id").write.json(path)
    schema = "source_id long, instruction string"
    default = with_dense_ids(spark.read.schema(schema).json(path))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "4096")
        small = materialize(with_dense_ids(spark.read.schema(schema).json(path)), "small-splits")
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
    return default.join(small.select("source_id", F.col("row_id").alias("row_id_small")), "source_id")


def stage_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published versions of one stage table, the first read back pinned after the second."""
    path = new_path(spark, "versioned")
    first = versions.publish(given.instruction_table(spark, sf_dir).select("row_id", F.col("instruction").alias("text")), path)
    second = versions.publish(_improved(spark, sf_dir).select("row_id", F.col("instruction_improved").alias("text")), path)
    old = versions.read_version(spark, path, first).withColumn("version", F.lit(first))
    new = versions.read_version(spark, path).withColumn("version", F.lit(second))
    return old.unionByName(new)


def checkpoint_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, then a third cut off in the middle of its line; the good rows survive."""
    path = new_path(spark, "torn")
    rows = given.responses(spark, sf_dir).select("row_id", "field", "response", "attempt")
    for attempt in (1, 2):
        jsonl.save_checkpoint(rows.where(F.col("attempt") == attempt), path)
    # The writer dies halfway through the line of one row.
    line = F.to_json(F.struct(*rows.columns))
    half = F.expr("substring(_line, 1, length(_line) div 2)")
    torn = rows.orderBy("row_id", "field", "attempt").limit(1).select(line.alias("_line")).select(half.alias("value"))
    torn.write.mode("append").text(path)
    found = jsonl.salvage_checkpoint(spark, path, rows.schema, most_broken=1)
    return found.rows.withColumn("quarantined", F.lit(found.n_broken).cast("long"))


def response_store_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store filled attempt by attempt, read as latest."""
    kept = store.ResponseStore(spark, new_path(spark, "responses"))
    rows = materialize(given.responses(spark, sf_dir), "attempts")
    for attempt in (1, 2):
        kept.append(rows.where(F.col("attempt") == attempt), "improve", attempt)
    return kept.latest("improve")


# --- Projections and predicates --------------------------------------------


def subset_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(given.instruction_table(spark, sf_dir), 100)


def subset_nth_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the table, by a key selected in ranges."""
    table = given.instruction_table(spark, sf_dir)
    return first_rows(table, table.count() // 2)


def _first_improved(spark: SparkSession, sf_dir: str, n: int) -> tuple[DataFrame, DataFrame]:
    """The first rows of the source, improved, and their keys."""
    base = first_rows(given.instruction_table(spark, sf_dir), n)
    keys = base.select("row_id")
    mine = given.responses(spark, sf_dir).join(keys, "row_id", "left_semi")
    return improved_from_responses(base, mine), keys


def compare_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["instruction", "instruction_improved", "output", "output_improved", "output_en"]
    improved, _ = _first_improved(spark, sf_dir, 5)
    return preview(improved, columns, 5, 200)


def distill_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    widths = {"instruction_improved": 120, "output_improved": 200, "output_generated": 200, "output_polished": 200}
    improved, keys = _first_improved(spark, sf_dir, 5)
    answers = given.answer_responses(spark, sf_dir).join(keys, "row_id", "left_semi")
    polishes = given.polish_responses(spark, sf_dir).join(keys, "row_id", "left_semi")
    polished = polish_from_responses(answers_from_responses(improved, answers), polishes)
    return preview(polished, widths)


def skip_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    skipped = should_skip(F.col("text"), F.col("ref_text")).alias("skipped")
    return _pairs(spark, sf_dir).select("row_id", "field", skipped)


def skip_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_skips(_pairs(spark, sf_dir))


def rewrite_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = rewrite_prompt(F.col("text"), F.col("ref_text")).alias("prompt")
    return _pairs(spark, sf_dir).select("row_id", "field", prompt)


def _messages(spark: SparkSession, sf_dir: str, system: str | None) -> DataFrame:
    prompt = chat_prompt(F.col("instruction"), F.col("input"), system)
    return given.instruction_table(spark, sf_dir).select(
        "row_id", F.posexplode(prompt).alias("pos", "message")
    ).select("row_id", "pos", "message.role", "message.content")


def chat_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir, None)


def chat_prompts_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir, SYSTEM_MESSAGE)


# --- Generation ------------------------------------------------------------


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.pending(_pairs(spark, sf_dir), given.responses(spark, sf_dir))


def attach_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answered_pairs(spark, sf_dir).select("row_id", "field", "response")


def improve_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long form: responses joined per field, then skip and validation."""
    result = accepted_text(F.col("text"), F.col("ref_text"), F.col("response")).alias("result")
    return _answered_pairs(spark, sf_dir).select("row_id", "field", result)


def improved_gathered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long form gathered back into columns."""
    long = improve_replay(spark, sf_dir)
    return gather_fields(given.instruction_table(spark, sf_dir), long, "result")


def _shouting() -> Callable[[list], list[str]]:
    """A generator whose answers SQL can tell: the last line of a prompt, marked."""
    return lambda prompts: [
        (p if isinstance(p, str) else p[-1]["content"]).rsplit("\n\n", 1)[-1] + " !" for p in prompts
    ]


def _declining() -> Callable[[list], list[str | None]]:
    """Answers texts of even length only."""
    return lambda prompts: [p + " !" if len(p) % 2 == 0 else None for p in prompts]


def generate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip, prompt, generate in batches, validate, in one pass."""
    return rewrite(_pairs(spark, sf_dir), _shouting, template="{reference}\n\n{text}").select(
        "row_id", "field", "result"
    )


def generate_budgeted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``generate_batches`` with batches of like length under a token budget."""
    asked = with_rewrite_prompt(_pairs(spark, sf_dir), "text", "ref_text", "_prompt", "{reference}\n\n{text}")
    answered = generate_by_budget(asked, "_prompt", "_response", _shouting, token_budget=4096, most_rows=32)
    final = accepted_text(F.col("text"), F.col("ref_text"), F.col("_response"))
    return answered.select("row_id", "field", final.alias("result"))


def _fragile() -> Callable[[list], list[str]]:
    """``_shouting``, but a batch with a prompt whose length is a multiple of seven fails whole."""
    shout = _shouting()

    def ask(prompts: list) -> list[str]:
        for p in prompts:
            if len(p) % 7 == 0:
                raise ValueError(f"cannot answer a prompt of {len(p)} characters")
        return shout(prompts)

    return ask


def generate_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing batches are halved until the prompts that fail are alone; those keep an error."""
    asked = with_rewrite_prompt(_pairs(spark, sf_dir), "text", "ref_text", "_prompt", "{reference}\n\n{text}")
    answered = generate_by_budget(asked, "_prompt", "response", _fragile, token_budget=4096, most_rows=32)
    return answered.select("row_id", "field", "response", "error")


def improve_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Improve through a store in several commits, twice: the rerun finds nothing to ask."""
    kept = store.ResponseStore(spark, new_path(spark, "responses"))
    table = materialize(given.instruction_table(spark, sf_dir), "instructions")
    for _ in range(2):
        improved = improve(table, kept, _shouting, parts=3, template="{reference}\n\n{text}")
    return improved


def standard_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Improve with a generator, then prepare, check and publish."""
    kept = store.ResponseStore(spark, new_path(spark, "responses"))
    table = materialize(given.instruction_table(spark, sf_dir), "instructions")
    options = chains.StageOptions(template="{reference}\n\n{text}", parts=2)
    prepared, _ = chains.standard_chain(table, kept, _shouting, new_path(spark, "chain"), options=options)
    return _flat_prompt(prepared)


def _answering() -> Callable[[list], list[str]]:
    """An answerer whose answers SQL can tell: the user's text, marked."""
    return lambda prompts: [p[-1]["content"] + " svar" for p in prompts]


def distilled_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Improve, answer, polish with generators, then prepare with the polished answers and publish."""
    kept = store.ResponseStore(spark, new_path(spark, "responses"))
    table = materialize(given.instruction_table(spark, sf_dir), "instructions")
    options = chains.StageOptions(template="{reference}\n\n{text}", parts=2, system=None)
    prepared, _ = chains.distilled_chain(table, kept, _shouting, _answering, new_path(spark, "chain"), options=options)
    return _flat_prompt(prepared)


def resume_changed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is pending after a first run once every third text has changed.

    The first run's generator answers only prompts of even length.
    """
    kept = store.ResponseStore(spark, new_path(spark, "responses"))
    pairs = materialize(_pairs(spark, sf_dir), "pairs")
    asked = pairs.select("row_id", "field", F.col("text").alias("prompt"))
    generate_pending(asked, kept, "improve", _declining, parts=2)
    changed = F.when(F.col("row_id") % 3 == 0, F.concat("prompt", F.lit(" mer"))).otherwise(F.col("prompt"))
    return kept.pending(asked.withColumn("prompt", changed), "improve").select("row_id", "field")


# --- Response validation ---------------------------------------------------


def validate_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = with_validated(_answered_pairs(spark, sf_dir))
    return checked.select("row_id", "field", "reason", "result")


def validate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of whole documents against the documents, text only."""
    docs = given.documents(spark, sf_dir)
    result = validate_response(_near_copy(), F.col("text"))
    return docs.select("doc_id", F.length(result).cast("bigint").alias("chars"), F.md5(result).alias("digest"))


def _near_copy() -> Column:
    return F.concat(F.lit("  "), F.regexp_replace("text", "e ", "en "))


def preamble_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    response = F.col("response")
    return (
        _answered_pairs(spark, sf_dir)
        .where(has_marker_prefix(response))
        .select("row_id", "field", usable_line(response).alias("line"))
    )


def word_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    overlap = word_overlap(strip(F.col("response")), F.col("text")).alias("overlap")
    return (
        _answered_pairs(spark, sf_dir)
        .where(F.col("response").isNotNull())
        .select("row_id", "field", overlap)
    )


def validation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reason_counts(with_validated(_answered_pairs(spark, sf_dir)))


# --- Classification and reports --------------------------------------------


def task_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = task_type(F.col("instruction_en")).alias("task_type")
    return given.instruction_table(spark, sf_dir).select("row_id", label)


def prepared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_prompt(_prepared(spark, sf_dir))


def task_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.task_distribution(_labelled(spark, sf_dir))


def task_distribution_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.task_distribution_pct(_labelled(spark, sf_dir))


def sample_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sample_per_task(_labelled(spark, sf_dir))


def _flat_report(prepared: DataFrame) -> DataFrame:
    """The report row with its map and list as text, so that SQL can compare it."""
    report = reports.validation_report(prepared)
    entries = F.array_sort(F.map_entries("task_type_distribution"))
    flat = F.transform(
        entries, lambda e: F.concat(e.getField("key"), F.lit("="), e.getField("value").cast("string"))
    )
    return report.select(
        "total_rows",
        "empty_prompts",
        F.array_join(flat, ",").alias("task_types"),
        F.array_join("missing_columns", ",").alias("missing"),
        "is_valid",
    )


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_report(_prepared(spark, sf_dir))


def publish_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepare, write and report in one pass; the report row and what the new version holds."""
    rows, report, number = publish_checked(_improved(spark, sf_dir), new_path(spark, "published"))
    labels = ",".join(f"{k}={v}" for k, v in sorted(report["task_type_distribution"].items()))
    return spark.createDataFrame(
        [(report["total_rows"], report["empty_prompts"], labels, ",".join(report["missing_columns"]),
          report["is_valid"], rows.count(), number)],
        "total_rows long, empty_prompts long, task_types string, missing string, is_valid boolean, "
        "published_rows long, version int",
    )


def _prepared_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given.documents(spark, sf_dir)
    return prepare(
        docs.select(
            "doc_id",
            F.col("text").alias("instruction_improved"),
            F.lit("").alias("input_improved"),
            F.col("text").alias("output_improved"),
            F.col("text").alias("instruction_en"),
        )
    )


def prepare_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as instructions: long texts through prompt and labels."""
    return _prepared_documents(spark, sf_dir).select(
        "doc_id", "task_type", F.md5(first_content(F.col("prompt"))).alias("digest")
    )


def documents_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_report(_prepared_documents(spark, sf_dir))


def invalid_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on a table with blank prompts and a missing column."""
    table = given.instruction_table(spark, sf_dir)
    blank = F.when(F.col("row_id") % 3 == 0, F.lit(" \u00a0 ")).otherwise(F.col("instruction"))
    improved = table.withColumns({"instruction_improved": blank, "input_improved": F.col("input")})
    return _flat_report(prepare(improved.drop("output")))


def change_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.change_stats(_improved(spark, sf_dir))


def polish_change_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.change_rate(_polished(spark, sf_dir), "output_generated", "output_polished")


# --- Distillation ----------------------------------------------------------


def distil_generate_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generated(spark, sf_dir).select("row_id", "output_improved", "output_generated")


def distil_polish_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _polished(spark, sf_dir).select("row_id", "output_generated", "output_polished")


def reference_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_reference(_polished(spark, sf_dir)).select(
        "row_id", "output_improved", "output_improved_phase1"
    )


def distilled_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_prompt(prepare_distilled(_polished(spark, sf_dir)))


# --- Rewards ---------------------------------------------------------------


def completion_reference_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paired(spark, sf_dir).select(
        "prompt_id", "completion_id", "completion", "output_improved", "task_type"
    )


def language_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given.documents(spark, sf_dir)
    text = F.col("text")
    return docs.select(
        "doc_id",
        language_reward(text).alias("language"),
        language_reward(text, DOCUMENT_ALPHABET, density=DOCUMENT_DENSITY).alias("language_document"),
    )


def length_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = length_reward(F.col("completion"), F.col("output_improved")).alias("length")
    return _paired(spark, sf_dir).select("prompt_id", "completion_id", value)


def accuracy_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = accuracy_reward(F.col("completion"), F.col("output_improved"), F.col("task_type"))
    return _paired(spark, sf_dir).select(
        "prompt_id", "completion_id", value.alias("accuracy")
    )


def semantic_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector and the next, the last one's being the first, at two scales."""
    vectors = given.read_table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "own_id")
    both = given.with_vectors(vectors, F.col("own_id") + 1, "next", sf_dir)
    left, right = F.col("embedding"), F.col("next")
    return both.withColumnRenamed("own_id", "vec_id").select(
        "vec_id",
        F.round(semantic_reward(left, right), 6).alias("semantic"),
        F.round(semantic_reward(left, right, WIDE_FLOOR, WIDE_SPAN), 6).alias("semantic_wide"),
    )


def _letter_counts() -> Callable[[list], list[list[float]]]:
    """An encoder SQL can follow: counts of a, e and spaces, and the length."""
    return lambda texts: [[t.count("a"), t.count("e"), t.count(" "), len(t)] for t in texts]


def embed_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semantic rewards with embeddings made by an encoder: references once, completions after the join."""
    completions = _paired(spark, sf_dir).select("prompt_id", "completion_id", "completion")
    references = given.references(spark, sf_dir).drop("reference_embedding")
    semantic = [r for r in DEFAULT_REWARDS if r.name == "semantic"]
    scored = score_completions(completions, references, _letter_counts, semantic)
    return scored.select("prompt_id", "completion_id", F.round("semantic", 6).alias("semantic"))


def weighted_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [*[r.name for r in DEFAULT_REWARDS], "total"]
    rounded = [F.round(name, 6).alias(name) for name in names]
    return _scored(spark, sf_dir).select("prompt_id", "completion_id", *rounded)


def group_advantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = materialize(_scored(spark, sf_dir), "scored")
    return scoring.group_advantage(scored).select(
        "prompt_id", "completion_id", F.round("advantage", 6).alias("advantage")
    )


def own_reward_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and a reward of the user's own, ranked in units of the group's deviation.

    Every fourth completion holds its reference.
    """
    paired = _paired(spark, sf_dir)
    holding = F.concat(F.lit("Svar: "), F.col("output_improved"))
    said = F.when(F.col("completion_id") % 4 == 0, holding).otherwise(F.col("completion"))
    brief = Reward("brief", 0.5, lambda completion: (F.length(completion) < 300).cast("double"))
    accuracy = Reward("accuracy", 0.5, accuracy_reward)
    scored = scoring.score(paired.withColumn("completion", said), [accuracy, brief])
    names = ["prompt_id", "completion_id", "accuracy", "brief", "total"]
    ranked = scoring.group_advantage(materialize(scored.select(*names), "scored"), scale=True)
    return ranked.withColumn("advantage", F.round("advantage", 5))


def group_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of each completion with the others of its prompt, by first lines."""
    paired = _paired(spark, sf_dir).select("prompt_id", "completion_id", "completion")
    scored = group_reward(paired, AGREEMENT)
    return scored.select("prompt_id", "completion_id", F.round("agreement", 9).alias("agreement"))


def reward_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = scoring.reward_by_task(_scored(spark, sf_dir))
    means = [F.round(name, 6).alias(name) for name in summary.columns if name.startswith("avg_")]
    return summary.select("task_type", "n", *means)


# --- Streaming -------------------------------------------------------------


def incremental_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a file stream; only a digest of each result is kept."""
    # As a pattern it may stand for one file or for a folder of files.
    source = f"{sf_dir}/documents.parque[t]"
    kind = F.col("doc_id") % 4
    response = (
        F.when(kind == 0, F.concat(F.lit(" \n"), F.col("text")))
        .when(kind == 1, F.concat(F.lit(given.MARKER_HEAD), F.col("text")))
        .when(kind == 2, F.lit(given.SHORT_RESPONSE))
        .otherwise(_near_copy())
    )
    docs = spark.read.schema(given.SCHEMAS["documents"]).parquet(source)

    return validate_new_files(
        spark,
        source,
        docs.schema,
        new_path(spark, "validated"),
        new_path(spark, "validated-progress"),
        pairs=lambda new: new.withColumn("response", response),
        finish=lambda checked: checked.select("doc_id", "reason", F.md5("result").alias("digest")),
    )


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a growing folder: all documents, then a fifth of them edited, then
    the edited file again; and the second batch replayed.  Each key keeps the result of
    its newest input, processed once."""
    source, target, progress = (new_path(spark, name) for name in ("upsert-in", "upsert", "upsert-progress"))
    docs = spark.read.schema(given.SCHEMAS["documents"]).parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    edited = docs.withColumn(
        "text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" (edited)"))).otherwise(F.col("text"))
    )
    schema = docs.schema
    for run, table in enumerate((docs, edited, edited), start=1):
        table.write.parquet(f"{source}/run-{run}")

        def process(rows: DataFrame, run: int = run) -> DataFrame:
            return rows.select("doc_id", "_digest", F.md5("text").alias("digest"), F.lit(run).alias("processed_in"))

        upsert_files(spark, f"{source}/*", schema, target, progress, "doc_id", process)
    # A batch delivered again after a crash changes nothing.
    kept = UpsertTarget(spark, target, "doc_id")
    kept.merge(edited, 1, ["text"], lambda rows: rows.limit(0))
    return kept.read().select("doc_id", "digest", "processed_in")


QUERIES: dict[str, Query] = {
    "instruction_scan": instruction_scan,
    "stage_roundtrip": stage_roundtrip,
    "jsonl_roundtrip": jsonl_roundtrip,
    "checkpoint_scan": checkpoint_scan,
    "checkpoint_salvage": checkpoint_salvage,
    "response_store_latest": response_store_latest,
    "stage_versions": stage_versions,
    "ingest_dense_ids": ingest_dense_ids,
    "store_compacted": store_compacted,
    "subset_first_n": subset_first_n,
    "subset_nth_key": subset_nth_key,
    "field_pairs_unpivot": _pairs,
    "compare_preview": compare_preview,
    "distill_preview": distill_preview,
    "skip_predicate": skip_predicate,
    "skip_split_counts": skip_split_counts,
    "rewrite_prompt": rewrite_prompts,
    "chat_prompt": chat_prompts,
    "chat_prompt_system": chat_prompts_system,
    "resume_pending": resume_pending,
    "attach_responses": attach_responses,
    "improve_replay": improve_replay,
    "improved_wide": _improved,
    "improved_gathered": improved_gathered,
    "generate_batches": generate_batches,
    "generate_budgeted": generate_budgeted,
    "generate_with_failures": generate_with_failures,
    "improve_generated": improve_generated,
    "standard_chain": standard_chain,
    "distilled_chain": distilled_chain,
    "resume_changed_text": resume_changed_text,
    "validate_response": validate_responses,
    "validate_documents": validate_documents,
    "preamble_extract": preamble_extract,
    "word_overlap": word_overlaps,
    "validation_reasons": validation_reasons,
    "task_type": task_types,
    "prepared_table": prepared_table,
    "task_distribution": task_distribution,
    "task_distribution_pct": task_distribution_pct,
    "sample_per_task": sample_per_task,
    "validation_report": validation_report,
    "publish_observed": publish_observed,
    "prepare_documents": prepare_documents,
    "documents_report": documents_report,
    "invalid_report": invalid_report,
    "change_stats": change_stats,
    "polish_change_rate": polish_change_rate,
    "distill_generate_replay": distil_generate_replay,
    "distill_polish_replay": distil_polish_replay,
    "reference_swap": reference_swap,
    "distilled_prepared": distilled_prepared,
    "completion_reference_join": completion_reference_join,
    "language_reward": language_rewards,
    "length_reward": length_rewards,
    "accuracy_reward": accuracy_rewards,
    "semantic_reward": semantic_rewards,
    "embed_rewards": embed_rewards,
    "weighted_reward": weighted_reward,
    "group_advantage": group_advantage,
    "own_reward_scaled": own_reward_scaled,
    "reward_by_task": reward_by_task,
    "group_reward": group_rewards,
    "incremental_validate": incremental_validate,
    "incremental_upsert": incremental_upsert,
}
