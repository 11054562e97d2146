"""Plan-shape regressions: the properties the design relies on at scale."""
import pytest

from conftest import SF_SMALL
from tickwise.plans.registry import QUERIES


def plan(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, needle):
    return text.count(needle)


def test_flagship_two_shuffles_one_scan(spark):
    p = plan(spark, "f_features_intraday")
    assert count(p, "Exchange hashpartitioning") == 2
    assert count(p, "lineitem.parquet") == 1


def test_clean_reuses_bar_partitioning(spark):
    p = plan(spark, "p_clean")
    assert count(p, "Exchange hashpartitioning") == 1
    assert count(p, "lineitem.parquet") == 1


def test_validation_report_scans_features_once(spark):
    assert count(plan(spark, "f_validation_report"), "lineitem.parquet") == 1


def test_asof_join_is_not_a_range_join(spark):
    p = plan(spark, "f_asof_join")
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith(("m_", "k_"))))
def test_no_python_udf_or_cross_join(spark, key):
    p = plan(spark, key)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in p, (key, bad)


def test_date_filter_reaches_scan(spark):
    p = QUERIES["p_source_range"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p


def test_landing_scan_pushes_date_and_ticker(spark, scratch):
    import datetime as dt
    import os
    from test_sinks import landing_rows
    from tickwise.sources import prices as SP
    path = os.path.join(scratch, "pq")
    landing_rows(spark).write.parquet(path)
    df = SP.scan_landing(spark, path, start=dt.date(1997, 1, 1), end=dt.date(1998, 1, 1), tickers=["S1", "S2"])
    p = df._jdf.queryExecution().executedPlan().toString()
    pushed = p[p.index("PushedFilters"):]
    assert "GreaterThanOrEqual(Date" in pushed and "LessThan(Date" in pushed
    assert "In(ticker" in pushed


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def partition_filters(p):
    return p[p.index("PartitionFilters: ["):].split("]")[0]


def test_stored_tables_are_pruned_statically(spark, scratch, monkeypatch):
    """Reads of the price and feature tables for some tickers list only their buckets (and months)."""
    import datetime as dt
    import os
    from pyspark.sql import functions as F
    from tickwise.plans import refresh as RF
    from tickwise.sources import fixtures as FX
    from tickwise.sources import sinks as SK
    prices_path, path = os.path.join(scratch, "p"), os.path.join(scratch, "f")
    p = FX.prices(spark, SF_SMALL)
    done = SK.upsert_latest(spark, p, prices_path, 16)
    RF.refresh_features(spark, prices_path, path, done.first_dates, dt.date(2002, 1, 1), n_buckets=16)
    req = spark.createDataFrame([("S1",), ("S2",)], "ticker string")
    for df in (SK.read_features(spark, path, req), SK.read_features(spark, path, ["S1"]), SK.read_prices(spark, prices_path, req),
               SK.read_prices(spark, prices_path, ["S1"])):
        assert "ticker_bucket" in partition_filters(executed(df)), executed(df)
    since = executed(SK.read_prices(spark, prices_path, start=dt.date(1998, 3, 1)))
    assert "month" in partition_filters(since)
    # the merge and the refresh: every read of a stored table that they make
    seen = []
    real = SK._in_partitions
    monkeypatch.setattr(SK, "_in_partitions", lambda places: seen.append(places) or real(places))
    one = p.filter((F.col("ticker") == "S1") & (F.col("date") >= dt.date(1997, 3, 1)) & (F.col("date") < dt.date(1997, 4, 1)))
    done = SK.upsert_latest(spark, one.withColumn("close", F.col("close") + 1), prices_path)
    assert done.changed > 0 and all(list(x) == ["1997-03"] and len(x["1997-03"]) == 1 for x in seen) and seen
    plans = []
    write = SK.overwrite_buckets
    monkeypatch.setattr(SK, "overwrite_buckets", lambda df, *a, **k: plans.append(executed(df)) or write(df, *a, **k))
    RF.refresh_features(spark, prices_path, path, done.first_dates, dt.date(2002, 1, 1))
    scans = [x for x in plans[0].split("FileScan")[1:] if scratch in x]
    assert len(scans) >= 2 and all("ticker_bucket" in partition_filters(x) for x in scans)


def test_append_reads_its_source_once(spark, scratch, monkeypatch):
    """One scan of the source, and the stored keys of the given ingest date only."""
    import os
    from tickwise.sources import fixtures as FX
    from tickwise.sources import sinks as SK
    path = os.path.join(scratch, "p")
    p = FX.prices(spark, SF_SMALL)
    SK.append_new(spark, p, path)
    plans = []
    monkeypatch.setattr(SK, "write_counted", lambda df, *a: plans.append(executed(df)) or 0)
    SK.append_new(spark, p, path, partition_values=[FX.FIXTURE_INGEST_DATE])
    assert plans[0].count("lineitem.parquet") == 1 and "ingestion_timestamp" in partition_filters(plans[0][plans[0].rindex("FileScan"):])
