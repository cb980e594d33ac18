"""Every registered query against its SQL on the smallest data set."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check  # noqa: E402

import shelfmark.plans  # noqa: E402,F401
from shelfmark.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test data not mounted")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for t in check.TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    message, _ = check.compare(spark, con, name, SF)
    assert message.startswith(("ok", "rows-only")), message


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
