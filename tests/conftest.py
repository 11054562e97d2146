import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from tickwise.session import local_session
    warehouse = tempfile.mkdtemp(prefix="tickwise-warehouse-")
    s = local_session("*", 8, app="tickwise-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(autouse=True, scope="module")
def nothing_stays_cached():
    """What the tests of a file have cached is released after it."""
    yield
    spark = SparkSession.getActiveSession()
    if spark is not None:
        spark.catalog.clearCache()


@pytest.fixture
def scratch(tmp_path):
    """A fresh folder per test (pytest's own tmp dir, never reused)."""
    return str(tmp_path)


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def price_rows(spark, rows, ingest="2024-01-31"):
    """rows: (ticker, date, open, high, low, close, volume[, ingest])."""
    from tickwise.schemas import PRICE_SCHEMA
    out = []
    for r in rows:
        t, d, o, h, l, c, v = r[:7]
        ing = r[7] if len(r) > 7 else ingest
        out.append((t, D(d), o, h, l, c, c, v, D(ing)))
    return spark.createDataFrame(out, PRICE_SCHEMA)


def days(start: str, n: int) -> list[str]:
    d0 = D(start)
    return [(d0 + dt.timedelta(days=i)).isoformat() for i in range(n)]
