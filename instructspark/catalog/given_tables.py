"""Instruction tables, responses and completions derived from the given tables.

The given texts are invented words without task keywords or Norwegian letters,
so each derivation varies them by ``conv_id`` and ``turn`` until every branch of
the operators is taken.  All of it is whole-table Spark work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from instructspark.functions.classification import task_type
from instructspark.functions.text import sql_literal

# A row id is conv_id * TURN_SPACE + turn: unique for any conversation length.
TURN_SPACE = 1_000_000_000

# Turns from here on belong to companion rows.
COMPANION_TURN = 500_000_000
SHORT_INSTRUCTION = "Kort"

TASK_PREFIXES = [
    "Classify this: ",
    "List the points: ",
    "Write a note: ",
    "Summarize: ",
    "Explain: ",
    "A poem: ",
    "",
    "Rewrite: ",
]

SHORT_RESPONSE = " Kort "
MARKER_HEAD = "Her er teksten:\nKort\n   "
MARKER_ONLY = "Forbedret tekst:\nKort"


# The columns in use; stating them saves a job that reads file footers.
SCHEMAS = {
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "documents": "doc_id bigint, text string",
    "embeddings": "vec_id bigint, embedding array<float>",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents."""
    return read_table(spark, sf_dir, "documents")


def _case(index: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then {sql_literal(v)}" for i, v in enumerate(values))
    return f"case {index} {whens} end"


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the answer that follows, if any, and the system turn before.

    Neighbouring turns meet by equi-joins on (conv_id, turn), which is unique:
    a window per conversation would hang on one long conversation.  Both joins
    share one partitioning.  A seventh of the turns gets a companion row whose
    instruction is short by nature, at a turn of its own.
    """
    turns = read_table(spark, sf_dir, "conversations")

    def of_role(role: str, shift: int, name: str) -> DataFrame:
        mine = turns.where(F.col("role") == F.lit(role))
        return mine.selectExpr("conv_id", f"turn + {shift} as turn", f"text as {name}")

    key = ["conv_id", "turn"]
    joined = (
        of_role("user", 0, "said")
        .join(of_role("assistant", -1, "output"), key, "left")
        .join(of_role("system", 1, "system"), key, "left")
        .selectExpr("*", "coalesce(system, '') as input")
    )
    short = f"struct(turn + {COMPANION_TURN} as turn, {sql_literal(SHORT_INSTRUCTION)} as said)"
    own = "struct(turn, said)"
    rows = joined.selectExpr(
        "conv_id", "output", "input", f"inline(if((conv_id + turn) % 7 = 0, array({own}, {short}), array({own})))"
    )
    same = "(conv_id + turn) % 5 = 0"
    return rows.selectExpr(
        f"conv_id * {TURN_SPACE} + turn as row_id",
        "conv_id",
        "turn",
        "said as instruction",
        "input",
        "output",
        f"concat({_case('(conv_id * 7 + turn) % 8', TASK_PREFIXES)}, said) as instruction_en",
        f"if({same} or input = '', input, concat(input, ' (en)')) as input_en",
        f"if({same}, output, concat(output, ' (en)')) as output_en",
    )


def instruction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed six-column table."""
    return instructions(spark, sf_dir).drop("conv_id", "turn")


def _response(kind: str, text: str, other: str) -> str:
    """SQL text for a response of each kind that validation tells apart."""
    return f"""case {kind}
        when 0 then cast(null as string)
        when 1 then {sql_literal(SHORT_RESPONSE)}
        when 2 then concat({sql_literal(MARKER_HEAD)}, replace({text}, '\\n', ' '))
        when 3 then {sql_literal(MARKER_ONLY)}
        when 4 then {other}
        when 5 then repeat(concat({text}, ' '), 5)
        when 6 then concat('\\t ', {text}, '\\u00a0 ')
        else replace({text}, 'the ', 'en ') end"""


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rewrites of the three fields: ``row_id, field, response, attempt``.

    A fifth of the rows has none yet, a third of the others a second attempt.
    """
    entries = []
    for index, (text, other) in enumerate(
        [("instruction", "output"), ("input", "instruction"), ("output", "instruction")]
    ):
        first = _response(f"(conv_id + turn + {index}) % 8", text, other)
        second = f"concat({text}, ' igjen.')"
        for attempt, response in ((1, first), (2, second)):
            entries.append(f"struct('{text}' as field, {response} as response, {attempt} as attempt)")
    once = f"array({', '.join(entries[0::2])})"
    twice = f"array({', '.join(entries)})"
    return (
        instructions(spark, sf_dir)
        .where("(conv_id * 3 + turn) % 5 <> 0")
        .selectExpr("row_id", f"inline(if((conv_id + turn) % 3 = 0, {twice}, {once}))")
    )


def answer_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored raw answers; every eleventh row has none."""
    return (
        instructions(spark, sf_dir)
        .where("(conv_id * 5 + turn) % 11 <> 0")
        .selectExpr(
            "row_id",
            "'output' as field",
            "concat(' ', replace(output, 'and ', 'og ')) as response",
            "1 as attempt",
        )
    )


def polish_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rewrites of the raw answers, of every kind."""
    response = _response("(conv_id * 3 + turn) % 8", "output", "instruction")
    return instructions(spark, sf_dir).selectExpr(
        "row_id", "'output' as field", f"{response} as response", "1 as attempt"
    )


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per prompt: its first answer and task type.

    The first row is a minimum, so a long conversation combines before the
    shuffle.
    """
    first = F.min(F.struct("turn", "output", "instruction_en")).alias("first")
    answered = instructions(spark, sf_dir).where(F.col("output").isNotNull())
    prompts = answered.groupBy(F.col("conv_id").alias("prompt_id")).agg(first)
    return prompts.select(
        "prompt_id",
        F.col("first.output").alias("output_improved"),
        task_type(F.col("first.instruction_en")).alias("task_type"),
    )


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as completions of their conversation's prompt."""
    return (
        read_table(spark, sf_dir, "conversations")
        .where(F.col("role") == F.lit("assistant"))
        .selectExpr(
            "conv_id as prompt_id",
            f"conv_id * {TURN_SPACE} + turn as completion_id",
            "text as completion",
        )
    )


def with_vectors(df: DataFrame, number: Column, name: str, sf_dir: str) -> DataFrame:
    """Adds a given vector by row number, wrapping around at the end of the table.

    Numbers that differ by row deal the rows evenly over the vectors.
    """
    table = read_table(df.sparkSession, sf_dir, "embeddings")
    n = table.agg(F.count("*").alias("n")).scalar()
    vectors = table.select("vec_id", F.col("embedding").alias(name))
    return df.withColumn("vec_id", number % n).join(vectors, "vec_id", "left").drop("vec_id")
