import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfmark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, "4g")
    yield s
    s.stop()


@pytest.fixture
def ev(spark):
    """ev(fn, values, type): fn(column) for every value, in order."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]
    return run


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
