"""What several steps of a query read is computed once: the rows of lineitem that its tasks read are those of one scan."""
import pytest

from conftest import SF_SMALL
from tickwise.plans.registry import QUERIES
from tickwise.sources import fixtures as FX

ONCE = ["k_upsert_days", "k_evolve", "k_state_refresh", "k_incremental_refresh", "k_features_buckets", "k_rebucket", "k_catalog_read",
        "k_profile_increment", "k_daily_run", "p_landing_quarantine", "p_landing_quarantine_csv", "f_summary_all", "m_bands_rule",
        "m_rf_predictions", "m_metrics", "m_quality_bands", "m_model_roundtrip"]


@pytest.mark.parametrize("key, scans", [*((k, 1) for k in ONCE), ("m_tree_table", 2)])  # two models, each from its own features
def test_lineitem_is_read_once(spark, monkeypatch, key, scans):
    seen = spark.sparkContext.accumulator(0)
    real = FX.read_table

    def read(spark, sf_dir, name):
        df = real(spark, sf_dir, name)
        if name != "lineitem":
            return df

        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return df.mapInArrow(count, df.schema)

    monkeypatch.setattr(FX, "read_table", read)
    QUERIES[key](spark, SF_SMALL).collect()
    assert seen.value == scans * real(spark, SF_SMALL, "lineitem").count()


def test_bad_deliveries_are_written_by_many_tasks(spark, monkeypatch):
    """No part of a landing zone is gathered in one task."""
    from pyspark.sql import DataFrame
    gathered = []
    real = DataFrame.coalesce
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda df, n: gathered.append(n) or real(df, n))
    for key in ("p_landing_quarantine", "p_landing_quarantine_csv"):
        assert QUERIES[key](spark, SF_SMALL).count() > 0
    assert not gathered


def test_rows_below_a_quartile_are_counted_not_exploded(spark):
    """The grouping that picks the quartiles gets the rows between the bounds and a count for each bound, not each row below one."""
    from tickwise.operators import profile as PR
    df = spark.range(0, 40_000, 1, 4).selectExpr("cast(id as double) as x")
    out = PR.summary_selected(df, ["x"])
    assert out.select("p25", "p50", "p75").first() == (9999.75, 19999.5, 29999.25)
    assert "count_if" in out._jdf.queryExecution().analyzed().toString()


def test_a_bar_is_made_from_its_keys(spark):
    """The price isn't sorted and shuffled beside an ordering key that holds its parts; same rows as by price and key."""
    from conftest import D
    from pyspark.sql import functions as F
    made = FX.prices(spark, SF_SMALL)
    assert "min_by" not in made._jdf.queryExecution().analyzed().toString()
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    px = F.try_divide("l_extendedprice", "l_quantity")
    rows = [(1, 1, 1, 1, 2.0, 30.0), (1, 1, 1, 2, 0.0, 5.0), (1, 2, 1, 1, None, 7.0), (2, 1, 1, 1, 4.0, None), (None, 9, 1, 1, 4.0, 12.0)]
    lines = spark.createDataFrame([(s, o, p, n, q, e, D("2020-01-02")) for s, o, p, n, q, e in rows],
                                  "l_suppkey long, l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate date")
    want = lines.groupBy("l_suppkey").agg(F.min_by(px, key), F.max_by(px, key))
    got = _bars_of(spark, lines).select(F.substring("ticker", 2, 9).cast("long"), "open", "close")
    assert sorted(map(str, want.collect())) and {tuple(r) for r in want.collect()} == {tuple(r) for r in got.collect()}


def _bars_of(spark, lines):
    real, FX.read_table = FX.read_table, lambda *_: lines
    try:
        return FX.prices(spark, "")
    finally:
        FX.read_table = real


def test_a_stored_training_frame_is_not_written_twice(spark):
    """Over its checkpoint it is held in memory only."""
    from tickwise.plans import model as ML
    from tickwise.plans import registry as R
    held = ML.persist_input(R.labeled(spark, SF_SMALL), reliable=True)
    try:
        assert held.storageLevel.useMemory and not held.storageLevel.useDisk
    finally:
        held.unpersist()


@pytest.mark.parametrize("key", ["m_quality_bands", "m_model_roundtrip"])
def test_predictions_are_made_while_the_rows_are_held(spark, monkeypatch, key):
    """The close is not stored with the training rows, and every pass over these is before their release."""
    from tickwise.plans import model as ML
    from tickwise.plans import registry as R
    said = []
    release, gave, auc, load = ML.TrainResult.release, ML.train, R.RK.grouped_auc, ML.load_model
    monkeypatch.setattr(ML, "train", lambda df, *a, **k: said.append(("columns", "close" in df.columns)) or gave(df, *a, **k))
    monkeypatch.setattr(ML, "load_model", lambda *a: said.append("predicts") or load(*a))
    monkeypatch.setattr(R.RK, "grouped_auc", lambda *a: said.append("predicts") or auc(*a))
    monkeypatch.setattr(ML.TrainResult, "release", lambda res: said.append("release") or release(res))
    out = QUERIES[key](spark, SF_SMALL)
    assert said == [("columns", False), "predicts", "release"] and out.count() == 1
