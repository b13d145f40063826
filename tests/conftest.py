import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# Python workers import the package and the generators of the tests.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(ROOT), str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")]
)

from instructspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a column expression over rows given as tuples."""

    def run(column, schema, rows):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        df = spark.createDataFrame(numbered, f"_i int, {schema}").select("_i", column.alias("_v"))
        return [row["_v"] for row in sorted(df.collect(), key=lambda row: row["_i"])]

    return run


RAW = "row_id long, instruction string, input string, output string, " \
      "instruction_en string, input_en string, output_en string"


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Rows for each way through the skip rule."""
    return spark.createDataFrame(
        [
            # plain, without input
            (0, "Fortell om hvordan planter vokser.", "", "Planter bruker lys til å vokse.",
             "Explain how plants grow.", "", "Plants use light to grow."),
            # input equal to its English text: skipped
            (1, "Oversett setningen under.", "The dog ran home.", "Hunden løp hjem til oss.",
             "Translate the sentence.", "The dog ran home.", "The dog ran home to us."),
            # answer too short: skipped
            (2, "Hvor mange er to og to?", "", "4", "What is two plus two?", "", "4"),
            # NULL text
            (3, None, None, None, "Write a poem.", None, None),
            # input that is rewritten as well
            (4, "Lag en liste over dyrene i teksten.", "Elg og rein lever i Norge.",
             "Elg, rein og kanskje gaupe", "List the animals.", "Moose and reindeer live in Norway.",
             "Moose, reindeer"),
        ],
        RAW,
    )
