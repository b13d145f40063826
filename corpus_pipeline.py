"""A corpus from raw documents to a training mix, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as Parquet
and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from instructspark.llm.common import drop, pick_rows, place_by_number, place_in_file, store
from instructspark.session import new_path, remove_path, shared_folder, shared_names
from instructspark.llm.decontaminate import decontaminate, is_contaminated
from instructspark.llm.line_frequency import drop_boilerplate
from instructspark.llm.mixing import mixed_documents
from instructspark.llm.setsketch import near_duplicates
from instructspark.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


# A document at least this likely toxic is rejected.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones, does not reject."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model, output="_toxic").where(F.col("_toxic") < TOXIC).select(*COLUMNS)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are boilerplate of their source."""
    cleaned = drop_boilerplate(docs, host="source", text="text")
    return cleaned.select(
        "doc_id",
        F.col("clean_text").alias("text"),
        "lang",
        "source",
        F.length("clean_text").cast("long").alias("n_chars"),
    )


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents with ``_row``, an identity that stays the same when they are read again.

    A table read from Parquet (as every stage's input is) has its file and row index; any
    other table is numbered and written once.
    """
    try:
        return docs.select(*COLUMNS, place_in_file().alias("_row"))
    except AnalysisException:
        return store(docs.select(*COLUMNS).withColumn("_row", place_by_number()), "numbered")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, by five-word shingles, 0.8 alike.

    Every row is its own document: the near-duplicate search keys on (doc_id is NULL,
    doc_id, row identity).  The row that stays is the one of least doc_id (rows with a
    doc_id before rows without; among equal ids the first by identity); the others go,
    by row, so that a clean text under a repeated doc_id stays.  Texts are read again where
    they lie, not dealt out.
    """
    numbered = _numbered(docs)
    order = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    keyed = numbered.select(order.alias("_order"), "text")
    found = near_duplicates(keyed, key="_order", shingle=5, percent=80)
    kept = found.where(F.col("kept")).select(F.col("_order.row").alias("_row"), F.lit(1).alias("times"))
    kept = store(kept, "kept")
    drop(found)
    return pick_rows(numbered, kept, "_row", "times").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is benchmark text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark).where(~is_contaminated()).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the number of copies to take."""
    return mixed_documents(_numbered(docs), row="_row").select(*COLUMNS, "copies", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_site_lines),
    ("MinHash near-dedup", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Neither learned scores nor randomised rounding have a SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again.

    Once a stage's result is written, the intermediate tables the stage left in the
    shared folder are deleted, and so is the result of the stage before: the next stage
    reads only the new result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    previous = None
    for number, (_, stage) in enumerate(STAGES):
        before = shared_names(spark)
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = new_path(spark, "stage")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
            for name in shared_names(spark) - before - {path.rsplit("/", 1)[1]}:
                remove_path(spark, f"{shared_folder(spark)}/{name}")
            if previous is not None:
                remove_path(spark, previous)
            previous = path
    return docs
