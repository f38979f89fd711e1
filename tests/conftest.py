import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from offerlake.session import get_spark

    s = get_spark("local[4]", app="offerlake-tests", shuffle_partitions=8,
                  **{"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def _cut_small_documents(request, monkeypatch):
    """The tests of cutting have small documents, which ``read_feed`` would read in one piece."""
    if request.module.__name__.endswith("test_documents"):
        from offerlake.sources import documents

        monkeypatch.setattr(documents, "WHOLE", 0)


def run_expr(spark, values, fn, schema="v string"):
    """Apply a column expression to single-column rows and collect in order."""
    from pyspark.sql import functions as F

    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in df.select(fn(F.col("v")).alias("o"), "i").orderBy("i").collect()]
