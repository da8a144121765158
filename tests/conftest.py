import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_corpus(spark):
    def make(*texts, author="a", genre="g"):
        rows = [(f"d{i}", author, f"t{i}", genre, text) for i, text in enumerate(texts)]
        return spark.createDataFrame(
            rows, "id string, author string, title string, genre string, text string"
        )

    return make


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
