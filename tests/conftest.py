import os

import pytest

from cleartab import queries
from cleartab.session import build

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("staging"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.exists(f"{FOLDER}/lineitem.parquet"):
        pytest.skip("no test tables")
    queries.load()
    return FOLDER


@pytest.fixture
def values(spark):
    """Evaluate a column rule over a list of texts."""
    def run(rule, texts, dtype="string"):
        from pyspark.sql import functions as F
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {dtype}")
        return [r[0] for r in df.orderBy("i").select(rule(F.col("x"))).collect()]
    return run
