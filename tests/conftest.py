import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rostra.functions.text import Preprocess  # noqa: E402
from rostra.runtime import ship_package  # noqa: E402
from rostra.schemas import DATE, MEMBER, PARTY, SPEECH  # noqa: E402

SPEECHES = [
    (0, "A", "03/07/1989", "P1", "tax budget tax"),
    (1, "B", "12/01/1990", "P2", "budget school x"),
    (2, "A", "05/05/1990", "P1", None),
    (3, "C", "07/02/1990", None, "school school tax"),
    (4, "B", "01/01/1991", "P2", "health"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    return session


@pytest.fixture(scope="session")
def plain():
    """No stop words and no stemming, so that expected values can be read off."""
    return Preprocess(stopwords=(), suffixes=())


@pytest.fixture(scope="session")
def corpus(spark):
    columns = f"doc_id long, {MEMBER} string, {DATE} string, {PARTY} string, {SPEECH} string"
    return spark.createDataFrame(SPEECHES, columns)


@pytest.fixture(scope="session")
def built(corpus, plain, tmp_path_factory):
    from rostra.plans.build import build_index

    return build_index(corpus, plain, str(tmp_path_factory.mktemp("index")))
