import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vitrine.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build("local[4]", "vitrine-tests", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Apply a column function to texts and return the results."""
    from pyspark.sql import functions as F

    def run(fn, *texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        out = rows.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()
        return [r.v for r in out]

    return run
