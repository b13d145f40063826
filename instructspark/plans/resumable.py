"""Generation into a response store, in parts that commit one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instructspark.fixed_values import REWRITE_BATCH_SIZE
from instructspark.operators.generation import GeneratorFactory, generate
from instructspark.session import new_path, remove_path
from instructspark.sources.store import KEYS, ResponseStore, prompt_digest, with_attempts

# A commit is a Spark job: large enough to fill a cluster, small enough to lose.
ROWS_PER_COMMIT = 200_000

# Smaller work is committed in this many parts all the same.
LEAST_COMMITS = 8


def parts_for(rows: int, every: int = ROWS_PER_COMMIT, least: int = LEAST_COMMITS) -> int:
    """The number of parts that commits about every so many rows, and so many times at least."""
    return max(1, -(-rows // every), min(least, rows))


def generate_pending(
    asked: DataFrame,
    store: ResponseStore,
    stage: str,
    factory: GeneratorFactory,
    batch_size: int = REWRITE_BATCH_SIZE,
    parts: int | None = None,
    parallelism: int | None = None,
    rows_per_commit: int = ROWS_PER_COMMIT,
) -> None:
    """Generates for every ``row_id, field, prompt`` row whose prompt the store has no answer to.

    Rows with a NULL prompt are not asked.  The pending work is written once,
    split by a hash of its key into ``parts`` folders, or as many as commit about every
    ``rows_per_commit`` rows; each part is read alone, dealt evenly over
    ``parallelism`` tasks, generated and appended in one job.  After a crash, calling
    again continues with what is missing: at most one part is lost.
    """
    spark = asked.sparkSession
    tasks = parallelism or spark.sparkContext.defaultParallelism
    work = with_attempts(asked.where(F.col("prompt").isNotNull()), store.read(stage))
    work = work.select(*KEYS, "prompt", "attempt")
    if parts is None:
        parts = parts_for(work.count(), rows_per_commit)
    if parts == 1:
        _generate_part(work, store, stage, factory, batch_size, tasks)
        return
    part = F.pmod(F.xxhash64(*KEYS), F.lit(parts))
    folder = new_path(spark, "pending")
    split = work.withColumn("part", part).repartition("part", F.pmod(F.hash(*KEYS), F.lit(tasks)))
    split.write.partitionBy("part").parquet(folder)
    saved = spark.read.schema(split.schema).parquet(folder)
    for number in range(parts):
        mine = saved.where(F.col("part") == F.lit(number)).drop("part")
        _generate_part(mine, store, stage, factory, batch_size, tasks)
    remove_path(spark, folder)


def _generate_part(
    work: DataFrame,
    store: ResponseStore,
    stage: str,
    factory: GeneratorFactory,
    batch_size: int,
    tasks: int,
) -> None:
    # Generation dwarfs a shuffle of its prompts, so deal them out evenly.
    spread = work.repartition(tasks, *KEYS)
    answered = generate(spread, "prompt", "response", factory, batch_size)
    store.append(answered.withColumn("prompt_sha", prompt_digest(F.col("prompt"))), stage)
