import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickweave import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session.build(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column builder on a list of texts."""
    from pyspark.sql import functions as F

    def run(build, texts, **constants):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
        for name, value in constants.items():
            df = df.withColumn(name, value)
        return [r[0] for r in df.select("i", build(F.col("s")).alias("v")).orderBy("i").select("v").collect()]

    return run
