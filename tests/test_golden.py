"""Hand-computed golden frames for the edge cases of the feature engine."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import D, days, price_rows
from tickwise.operators import asof as AS
from tickwise.operators import clean as C
from tickwise.operators import features as FE
from tickwise.operators import labels as LB
from tickwise.operators import profile as PR
from tickwise.operators import quality as QA
from tickwise.plans import daily_run as DR
from tickwise.sources import prices as SP

RUN = dt.date(2024, 2, 1)


def rising(spark, n=12, ticker="AAA", start="2024-01-01"):
    rows = [(ticker, d, 100.0 + i, 101.0 + i, 99.0 + i, 100.5 + i, 1000 + i)
            for i, d in enumerate(days(start, n))]
    return price_rows(spark, rows)


def by_date(df):
    return {r["date"]: r for r in df.collect()}


def test_rising_intraday_partial_frames(spark):
    f = FE.create_features(rising(spark), "intraday", RUN).orderBy("date").collect()
    assert len(f) == 12
    closes = [100.5 + i for i in range(12)]
    for i, r in enumerate(f):
        assert r["moving_avg_7"] == pytest.approx(sum(closes[max(0, i - 6):i + 1]) / min(i + 1, 7))
        assert r["moving_avg_30"] == pytest.approx(sum(closes[:i + 1]) / (i + 1))
        assert r["daily_return"] == pytest.approx(0.5 / (100.0 + i))
        assert r["feature_timestamp"] == RUN
        assert isinstance(r["volume"], float)
    assert f[0]["volatility_7"] is None and f[1]["volatility_7"] is not None
    assert [r["momentum"] is None for r in f] == [True] * 7 + [False] * 5
    assert f[7]["momentum"] == pytest.approx(closes[7] / closes[0])


def test_rising_close_to_close(spark):
    f = FE.create_features(rising(spark), "close_to_close", RUN).orderBy("date").collect()
    assert len(f) == 11  # first row has no previous close
    closes = [100.5 + i for i in range(12)]
    assert f[0]["daily_return"] == pytest.approx(1.0 / closes[0])
    assert f[0]["volatility_7"] is None and f[1]["volatility_7"] is not None
    # momentum needs 10 earlier rows: original rows 2..10 have none
    assert sum(r["momentum"] is None for r in f) == 9
    assert f[9]["momentum"] == pytest.approx((closes[10] - closes[0]) / closes[0])
    # moving averages still see the dropped first row
    assert f[0]["moving_avg_7"] == pytest.approx((closes[0] + closes[1]) / 2)
    assert isinstance(f[0]["volume"], int)


def test_null_counts_both_variants(spark):
    for variant, expect in (("intraday", {"volatility_7": 1, "momentum": 7}),
                            ("close_to_close", {"volatility_7": 1, "momentum": 9})):
        f = FE.create_features(rising(spark), variant, RUN)
        nulls = PR.null_counts(f).collect()[0]
        for c, n in expect.items():
            assert nulls[c] == n, (variant, c)
        assert nulls["moving_avg_7"] == 0 and nulls["moving_avg_30"] == 0


def test_one_row_ticker(spark):
    one = price_rows(spark, [("ONE", "2024-01-05", 10.0, 11.0, 9.0, 10.5, 5)])
    f = FE.create_features(one, "intraday", RUN).collect()
    assert len(f) == 1 and f[0]["volatility_7"] is None and f[0]["momentum"] is None
    assert LB.create_labels(LB.training_read(f and FE.create_features(one, "intraday", RUN))).count() == 0
    assert PR.gaps(one).count() == 0


def test_equal_closes_label_zero(spark):
    rows = [("EQ", d, 10.0, 10.0, 10.0, c, 1) for d, c in zip(days("2024-01-01", 4), [10.0, 10.0, 11.0, 9.0])]
    f = FE.create_features(price_rows(spark, rows), "intraday", RUN)
    lab = {r["date"]: r["next_day_up"] for r in LB.create_labels(LB.training_read(f)).collect()}
    assert lab == {D("2024-01-01"): 0, D("2024-01-02"): 1, D("2024-01-03"): 0}


def test_zero_open_and_zero_previous_close(spark):
    rows = [("Z", "2024-01-01", 0.0, 1.0, 0.0, 0.0, 1),
            ("Z", "2024-01-02", 1.0, 2.0, 1.0, 2.0, 1),
            ("Z", "2024-01-03", 2.0, 3.0, 2.0, 3.0, 1)]
    df = price_rows(spark, rows)
    intra = by_date(FE.create_features(df, "intraday", RUN))
    assert intra[D("2024-01-01")]["daily_return"] is None  # open = 0 -> NULL, no error
    c2c = by_date(FE.create_features(df, "close_to_close", RUN))
    # 01-02 follows a close of 0: return NULL, row dropped like the first row
    assert set(c2c) == {D("2024-01-03")}
    assert c2c[D("2024-01-03")]["daily_return"] == pytest.approx(0.5)


def test_nan_and_null_dropped_by_clean(spark):
    rows = [("N", "2024-01-01", 1.0, 1.0, 1.0, float("nan"), 1),
            ("N", "2024-01-02", 1.0, 1.0, 1.0, None, 1),
            ("N", "2024-01-03", 1.0, 1.0, 1.0, 1.0, None),
            ("N", "2024-01-04", 1.0, 1.0, 1.0, 1.0, 1)]
    out = C.clean(price_rows(spark, rows)).collect()
    assert [r["date"] for r in out] == [D("2024-01-04")]
    counts = C.clean_counts(price_rows(spark, rows)).collect()[0]
    assert (counts["rows_before"], counts["rows_after"], counts["rows_removed"]) == (4, 1, 3)


def test_duplicate_newest_ingest_wins(spark):
    rows = [("D", "2024-01-01", 1.0, 1.0, 1.0, 5.0, 1, "2024-01-10"),
            ("D", "2024-01-01", 1.0, 1.0, 1.0, 7.0, 1, "2024-01-11"),
            ("D", "2024-01-01", 1.0, 1.0, 1.0, 9.0, 1, "2024-01-09"),
            ("D", "2024-01-02", 1.0, 1.0, 1.0, 3.0, 1, "2024-01-10"),
            ("D", "2024-01-02", 1.0, 1.0, 1.0, 4.0, 1, "2024-01-10")]
    out = {r["date"]: r["close"] for r in C.clean(price_rows(spark, rows)).collect()}
    assert out == {D("2024-01-01"): 7.0, D("2024-01-02"): 4.0}  # tie -> larger close


def test_requested_ticker_without_rows(spark):
    df = rising(spark, 3)
    req = spark.createDataFrame([("AAA",), ("MISSING",)], "ticker string")
    st = {r["ticker"]: r for r in SP.source_status(req, df).collect()}
    assert st["AAA"]["status"] == "ok" and st["AAA"]["row_count"] == 3
    assert st["MISSING"]["status"] == "failed" and st["MISSING"]["row_count"] == 0
    assert st["AAA"]["total_rows"] == st["MISSING"]["total_rows"] == 3
    run = {r["ticker"]: r for r in DR.run_status(df, req, "intraday", RUN).collect()}
    assert run["AAA"]["status"] == "processed" and run["AAA"]["feature_rows"] == 3
    assert run["MISSING"]["status"] == "failed" and run["MISSING"]["reason"] == "no_data"
    summary = DR.run_summary(DR.run_status(df, req, "intraday", RUN)).collect()[0]
    assert (summary["processed"], summary["failed"], summary["total_feature_rows"]) == (1, 1, 3)


def test_all_requested_missing_raises(spark):
    req = spark.createDataFrame([("X",)], "ticker string")
    with pytest.raises(SP.MissingTableError):
        SP.require_any(SP.source_status(req, rising(spark, 2)))


def smooth(spark, n=200):
    rows = []
    for i, d in enumerate(days("2024-01-01", n)):
        c = 100.0 * (1.001 ** i)
        rows.append(("SM", d, c * 0.9995, c * 1.001, c * 0.999, c, 100))
    return FE.create_features(price_rows(spark, rows), "intraday", RUN)


def test_clean_smooth_table_passes(spark):
    f = smooth(spark)
    assert QA.validate_columns(f)
    rep = QA.validation_report(f).collect()[0]
    assert rep["columns_ok"] and rep["null_ok"] and rep["outlier_ok"] and rep["passed"]
    # momentum ratio ~1.007 is below 1.5; 1 null of 200 (0.5 %) -> ok,
    # 7 of 200 (3.5 %) -> warn, neither fails
    bands = {r["column_name"]: r["band"] for r in QA.null_report(f).collect()}
    assert bands["volatility_7"] == "ok" and bands["momentum"] == "warn"


def test_strict_bounds_exact_percentages(spark):
    # 20 rows, 1 null -> exactly 5.0 % -> warn (fail needs > 5)
    rows = [("B", d, 1.0, 1.0, 1.0, 1.0, 1) for d in days("2024-01-01", 20)]
    df = price_rows(spark, rows).withColumn(
        "x", F.when(F.col("date") == D("2024-01-01"), None).otherwise(F.lit(1.0)))
    band = {r["column_name"]: (r["null_pct"], r["band"]) for r in QA.null_report(df).collect()}
    assert band["x"] == (5.0, "warn")
    # 100 rows, 1 null -> exactly 1.0 % -> ok (warn needs > 1)
    rows = [("B", d, 1.0, 1.0, 1.0, 1.0, 1) for d in days("2024-01-01", 100)]
    df = price_rows(spark, rows).withColumn(
        "x", F.when(F.col("date") == D("2024-01-01"), None).otherwise(F.lit(1.0)))
    band = {r["column_name"]: (r["null_pct"], r["band"]) for r in QA.null_report(df).collect()}
    assert band["x"] == (1.0, "ok")
    # exactly 1.0 % extreme returns fails the verdict (needs < 1); 0.2 itself is not an outlier
    f = df.withColumn("daily_return", F.when(F.col("date") == D("2024-01-01"), 0.5)
                      .when(F.col("date") == D("2024-01-02"), 0.2).otherwise(0.0))
    v = QA.outlier_verdict(f).collect()[0]
    assert (v["extreme_outliers"], v["outlier_pct"], v["outlier_ok"]) == (1, 1.0, False)


def test_empty_feature_table(spark):
    f = smooth(spark).limit(0)
    rep = QA.validation_report(f)
    assert rep.count() == 0
    s = QA.validation_summary(rep).collect()[0]
    assert (s["tables_validated"], s["total_rows"], s["avg_columns"], s["all_passed"]) == (0, 0, 0.0, True)
    req = spark.createDataFrame([("SM",)], "ticker string")
    r = QA.validation_report(f, req).collect()[0]
    assert r["table_exists"] is False and r["passed"] is False


def test_top_outliers_reports_every_ticker(spark):
    rows = [(t, d, 1.0, 1.0, 1.0, 1.0, 1) for t in ("G", "H") for d in days("2024-01-01", 30)]
    day = F.dayofmonth("date")
    f = price_rows(spark, rows).withColumn("daily_return", F.when((F.col("ticker") == "G") & (day > 12), 0.0).otherwise(day * 1.0))
    out = {t: [(r["daily_return"], r["n_extreme"]) for r in QA.top_outliers(f).collect() if r["ticker"] == t] for t in "GH"}
    assert out["G"] == [(float(x), 12) for x in range(12, 2, -1)]
    assert out["H"] == [(float(x), 30) for x in range(30, 20, -1)]  # the ticker with the most isn't hidden


def test_asof_inclusive_and_before_first(spark):
    f = FE.create_features(rising(spark, 5, start="2024-01-10"), "intraday", RUN)
    req = spark.createDataFrame([(1, "AAA", D("2024-01-12")), (2, "AAA", D("2024-01-09")),
                                 (3, "AAA", D("2024-03-01")), (4, "NOPE", D("2024-01-12"))],
                                "request_id long, ticker string, as_of_date date")
    out = {r["request_id"]: r for r in AS.asof_join(req, f, ["close"]).collect()}
    assert out[1]["status"] == "ok" and out[1]["feature_date"] == D("2024-01-12")
    assert out[2]["status"] == "no_data_yet" and out[2]["close"] is None
    assert out[3]["feature_date"] == D("2024-01-14")
    assert out[4]["status"] == "no_ticker"
    one = AS.asof_latest(f, "AAA", "2024-01-12").collect()
    assert len(one) == 1 and one[0]["date"] == D("2024-01-12")
    assert AS.asof_latest(f, "AAA", "2024-01-09").count() == 0


def test_split_date_rule(spark):
    rows = [("S", d, 1.0, 1.0, 1.0, 1.0, 1) for d in days("2023-01-01", 10)]
    b = LB.split_bounds(price_rows(spark, rows)).collect()[0]
    # span 9 days, int(9 * 0.8) = 7 -> 2023-01-08
    assert b["split_date"] == D("2023-01-08")
    train, test = LB.split_data(price_rows(spark, rows))
    assert train.count() == 8 and test.count() == 2


def test_schema_gate_incomplete_table(spark):
    bad = rising(spark, 3).select("ticker", "date", "close")
    assert not QA.validate_columns(bad)
    r = QA.schema_check(bad).collect()[0]
    assert r["columns_ok"] is False and "momentum" in r["missing_columns"]
    with pytest.raises(ValueError):
        LB.training_read(bad)


def test_typed_projection_try_cast(spark):
    raw = spark.createDataFrame([("T", "2024-01-01", "1.5", "x", "1", "2", "2", "7", "2024-01-02")],
                                ", ".join(f"{c} string" for c in
                                          ["ticker", "date", "open", "high", "low", "close",
                                           "adj_close", "volume", "ingestion_timestamp"]))
    r = C.typed_projection(raw).collect()[0]
    assert r["open"] == 1.5 and r["high"] is None and r["volume"] == 7 and r["date"] == D("2024-01-01")


def test_source_normalize_and_adj_close_fallback(spark):
    raw = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 5, 0), 1.0, 2.0, 0.5, 1.5, 10)],
        "Date timestamp, Open double, High double, Low double, Close double, Volume long")
    r = SP.normalize_source(raw, D("2024-01-03"), ticker="T").collect()[0]
    assert (r["ticker"], r["date"], r["adj_close"], r["ingestion_timestamp"]) == (
        "T", D("2024-01-02"), 1.5, D("2024-01-03"))


def test_verify_scopes(spark):
    f = FE.create_features(rising(spark, 20), "close_to_close", RUN)
    full = QA.verify_return(f).orderBy("date").collect()
    assert len(full) == 5
    assert all(math.isclose(r["calculated_return"], round(r["daily_return"], 6)) for r in full)
    filt = QA.verify_return(f, scope="filtered").orderBy("date").collect()
    # the first row of the 8-day slice has no previous close inside the slice
    assert len(filt) == 5 and all(r["prev_close"] is not None for r in filt)
    ma = QA.verify_ma7(f).collect()
    assert all(r["calculated_ma7"] == round(r["moving_avg_7"], 2) for r in ma)


def test_completeness_band_boundaries(spark):
    def feats_with_nulls(n_rows, n_null):
        rows = [("CB", d, 1.0, 1.0, 1.0, 1.0, 1) for d in days("2024-01-01", n_rows)]
        df = price_rows(spark, rows)
        cut = D("2024-01-01") + dt.timedelta(days=n_null)
        return df.withColumn("momentum", F.when(F.col("date") < cut, None).otherwise(F.lit(1.0))) \
                 .withColumn("daily_return", F.lit(0.0)).withColumn("moving_avg_7", F.lit(1.0)) \
                 .withColumn("moving_avg_30", F.lit(1.0)).withColumn("volatility_7", F.lit(0.0))
    for n_rows, n_null, band in ((20, 1, "good"), (20, 4, "fair"), (20, 5, "poor")):
        r = {x["feature"]: x for x in QA.completeness(feats_with_nulls(n_rows, n_null)).collect()}
        assert r["momentum"]["band"] == band, (n_rows, n_null, r["momentum"])
    # 95.0 and 80.0 exactly are inclusive
    r = {x["feature"]: x for x in QA.completeness(feats_with_nulls(20, 1)).collect()}
    assert r["momentum"]["completeness_pct"] == 95.0


def test_thresholds_are_arguments(spark):
    """One null momentum and one extreme return in 20 rows: each verdict turns with its own threshold, bounds as by default."""
    n = price_rows(spark, [("TH", d, 1.0, 1.0, 1.0, 1.0, 1) for d in days("2024-01-01", 20)])
    first = F.col("date") == D("2024-01-01")
    df = n.withColumn("momentum", F.when(first, None).otherwise(F.lit(1.0))).withColumn("daily_return", F.when(first, 9.0).otherwise(F.lit(0.0)))
    verdict = lambda **k: QA.ticker_checks(df.select("ticker", "momentum", "daily_return"), **k).first()
    assert (verdict()["null_ok"], verdict()["outlier_ok"]) == (True, False)
    assert verdict(completeness=0.95)["null_ok"] and not verdict(completeness=0.96)["null_ok"]
    assert verdict(validity=0.94)["outlier_ok"] and not verdict(validity=0.95)["outlier_ok"]
    bands = {r["column_name"]: r["band"] for r in QA.null_report(df.select("ticker", "momentum", "daily_return"), 4.0, 2.0).collect()}
    assert bands == {"momentum": "fail", "daily_return": "ok"}
    got = {r["feature"]: r["band"] for r in QA.completeness(df, ["momentum", "daily_return"], 99.0, 96.0).collect()}
    assert got == {"momentum": "poor", "daily_return": "good"}


def test_model_band_boundaries(spark):
    from tickwise.plans import model as ML
    def bands(train, test):
        m = spark.createDataFrame([("train", "auc", train), ("test", "auc", test)],
                                  "split string, metric string, value double")
        r = ML.quality_bands(m).collect()[0]
        return r["auc_band"], r["gap_band"]
    assert bands(0.8, 0.8) == ("excellent", "low")
    # 0.75 - 0.7 is 0.050000000000000044 in doubles (as in plain Python): above 0.05
    assert bands(0.75, 0.7) == ("good", "moderate")
    assert bands(0.625, 0.6) == ("moderate", "low")
    assert bands(0.7, 0.6) == ("moderate", "moderate")
    assert bands(0.9, 0.59) == ("poor", "high")


def test_negative_prices_rows_and_counts(spark):
    p = price_rows(spark, [("N", d, o, 1.0, 1.0, c, 1) for d, o, c in zip(days("2024-01-01", 4), (1.0, -1.0, 1.0, -2.0), (1.0, 1.0, -1.0, -2.0))])
    assert C.negative_prices(p).count() == 3
    assert C.negative_price_counts(p).first()["negative_rows"] == 3


def test_download_window_is_a_year_before_its_end():
    run = D("2024-03-01")
    assert SP.default_range(run) == (D("2023-03-02"), run)
    assert SP.default_range(run, D("2020-01-01"), D("2021-01-01")) == (D("2020-01-01"), D("2021-01-01"))


def test_dedupe_is_total_with_extra_columns(spark):
    p = price_rows(spark, [("T", "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1)] * 3).withColumn("venue", F.lit("a"))
    p = p.unionByName(p.withColumn("venue", F.lit("b"))).repartition(4)
    for n in (1, 3):
        got = C.dedupe_latest(p.repartition(n)).collect()
        assert len(got) == 1 and got[0]["venue"] == "b"


def test_full_recompute_check_finds_one_wrong_value(spark):
    f = FE.create_features(rising(spark, 40), "close_to_close", RUN)
    assert QA.verify_summary(f).first()["passed"]
    day = f.orderBy("date").collect()[30]["date"]
    bad = f.withColumn("moving_avg_30", F.when(F.col("date") == day, F.col("moving_avg_30") + 1e-3).otherwise(F.col("moving_avg_30")))
    r = QA.verify_summary(bad).first()
    assert (r["ma30_mismatches"], r["ma7_mismatches"], r["return_mismatches"], r["passed"]) == (1, 0, 0, False)
