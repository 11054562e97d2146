"""Series cut into blocks give what whole series give."""
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import D, SF_SMALL, days, price_rows
from tickwise.operators import asof, blockwise, features
from tickwise.plans.registry import QUERIES

DATES = days("2019-01-01", 700)


@pytest.fixture(scope="module")
def hot(spark):
    """One ticker with two thirds of the rows, many short ones, one of a single row."""
    rows = [("HOT", d, 10.0 + i % 13, 12.0, 9.0, 10.0 + (i * 7) % 31, 100 + i) for i, d in enumerate(DATES)]
    for t in range(40):
        rows += [(f"T{t}", d, 5.0, 6.0, 4.0, 5.0 + (i * t) % 7, i) for i, d in enumerate(DATES[t:t + t % 17 + 1])]
    return price_rows(spark, rows).repartition(5).cache()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("variant", features.VARIANTS)
@pytest.mark.parametrize("block_rows", [29, 30, 64, 1 << 17])
def test_features_equal_those_of_whole_series_to_the_bit(hot, variant, block_rows):
    got = blockwise.create_features(hot, variant, "2024-01-01", block_rows=block_rows)
    want = features.create_features(hot, variant, "2024-01-01")
    assert got.schema.names == want.schema.names and got.dtypes == want.dtypes
    assert rows(got) == rows(want)


def test_blocks_have_the_size_asked_for(hot):
    cut = blockwise.in_blocks(hot, ["ticker"], ["date"], 29, 64)
    sizes = cut.groupBy("ticker", "_block").agg(F.count_if("_own").alias("own"), F.count_if(~F.col("_own")).alias("lent")).collect()
    assert max(r.own for r in sizes) == 64 and {r.lent for r in sizes if r.own} <= {0, 29}
    of_hot = {r._block: r for r in sizes if r.ticker == "HOT"}
    assert [of_hot[b].own for b in range(11)] == [64] * 10 + [60]
    assert cut.filter("_own").count() == hot.count()


def test_a_last_block_that_is_full_lends_to_no_one_else(spark):
    df = spark.range(128).selectExpr("'a' AS s", "id AS at")
    cut = blockwise.in_blocks(df, ["s"], ["at"], 29, 64)
    assert cut.filter("_own").count() == 128 and {r._block for r in cut.filter("_own").collect()} == {0, 1}


def test_places_are_those_of_a_window(hot):
    got = blockwise.with_places(hot.select("ticker", "date"), ["ticker"], ["date"])
    w = Window.partitionBy("ticker").orderBy("date")
    assert rows(got) == rows(hot.select("ticker", "date", (F.row_number().over(w) - 1).cast("long").alias("_place")))


def test_places_with_null_series_and_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("", 1), ("a", None), ("a", 3)], "s string, at int")
    assert rows(blockwise.with_places(df, ["s"], ["at"])) == rows(
        spark.createDataFrame([(None, 1, 0), (None, 2, 1), ("", 1, 0), ("a", None, 0), ("a", 3, 1)], "s string, at int, _place long"))
    assert blockwise.in_blocks(df.limit(0), ["s"], ["at"]).count() == 0


def test_halo_must_fit_into_a_block(hot):
    with pytest.raises(ValueError):
        blockwise.in_blocks(hot, ["ticker"], ["date"], 29, 28)


def test_asof_carries_over_partitions(spark, hot):
    """Requests between, before and after the rows; long stretches without a row; repeated and null keys."""
    feats = features.create_features(hot.filter("ticker <> 'HOT' OR dayofyear(date) < 4"), "intraday", "2024-01-01")
    req = [(i, "HOT", D(d)) for i, d in enumerate(days("2018-12-30", 720))]
    req += [(1000 + i, f"T{i % 43}", D("2019-02-01") + dt.timedelta(days=i % 9)) for i in range(300)]
    req += [(2000, None, D("2019-02-01")), (2001, "T5", None), (2002, "HOT", D("2019-05-05")), (2003, "HOT", D("2019-05-05"))]
    requests = spark.createDataFrame(req, "request_id int, ticker string, as_of_date date").repartition(7)
    cols = ["close", "moving_avg_7"]
    known = requests.filter("as_of_date IS NOT NULL")
    assert rows(blockwise.asof_join(known, feats, cols)) == rows(asof.asof_join(known, feats, cols))
    odd = {r.request_id: r.status for r in blockwise.asof_join(requests, feats, cols).filter("request_id IN (2000, 2001)").collect()}
    assert odd == {2000: asof.STATUS_NO_TICKER, 2001: asof.STATUS_NOT_YET}


def test_no_window_over_a_whole_series_of_rows(spark):
    """The windows over a series alone run over one row per series and partition."""
    p = QUERIES["f_ticks_blocked"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    ticks = QUERIES["f_ticks_blocked"](spark, SF_SMALL)
    assert ticks.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
