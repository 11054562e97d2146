"""Published tables: readers, writers, compaction; features from the rolling state."""
import datetime as dt
import os

import pytest
from conftest import SF_SMALL, D, price_rows
from pyspark.sql import functions as F

from tickwise.operators import clean as C
from tickwise.operators import features as FE
from tickwise.plans import daily_run as DR
from tickwise.plans import rolling as RO
from tickwise.sources import fixtures as FX
from tickwise.sources import published as PB
from tickwise.sources import sinks as SK
from tickwise.streaming import ingest as ST

RUN = D("2024-06-01")


def bars(spark, tickers, start, n, close=10.0):
    first = D(start)
    return price_rows(spark, [(t, (first + dt.timedelta(days=i)).isoformat(), 1.0, 2.0, 0.5, close + i % 7 + len(t), 5) for t in tickers for i in range(n)])


def files_of(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_reader_sees_whole_versions_only(spark, scratch, monkeypatch):
    """Between write and publish a reader has the old table, and a reader of the old version keeps it after."""
    SK.upsert_latest(spark, bars(spark, "AB", "2024-01-01", 20), scratch, 2)
    old = SK.read_prices(spark, scratch)
    seen = []
    real = PB.publish
    monkeypatch.setattr(PB, "publish", lambda *a, **k: seen.append(SK.read_prices(spark, scratch).agg(F.sum("close")).first()[0]) or real(*a, **k))
    before = old.agg(F.sum("close")).first()[0]
    SK.upsert_latest(spark, bars(spark, "AB", "2024-01-01", 20, close=50.0), scratch)
    after = SK.read_prices(spark, scratch).agg(F.sum("close")).first()[0]
    assert seen == [before] and after == before + 40 * 40 and old.agg(F.sum("close")).first()[0] == before


@pytest.mark.parametrize("other", ["2024-01-05", "2024-05-05"])
def test_two_writers_keep_both_changes(spark, scratch, monkeypatch, other):
    """The second to publish changes the same month (it merges again), or another one (it publishes on top)."""
    SK.upsert_latest(spark, bars(spark, "A", "2024-01-01", 3), scratch, 1)
    real, calls = PB.stage, []

    def slow(df, path, cols):
        out = real(df, path, cols)
        calls.append(path)
        if len(calls) == 1:  # another writer is faster
            SK.upsert_latest(spark, bars(spark, "A", other, 1, close=70.0), scratch)
        return out

    monkeypatch.setattr(PB, "stage", slow)
    done = SK.upsert_latest(spark, bars(spark, "A", "2024-01-20", 2, close=30.0), scratch)
    assert len(calls) == (3 if other == "2024-01-05" else 2) and done.changed == 2
    assert {str(r["date"]) for r in SK.read_prices(spark, scratch).collect()} == {
        "2024-01-01", "2024-01-02", "2024-01-03", other, "2024-01-20", "2024-01-21"}
    assert PB.current(spark, scratch).number == 3


def test_a_number_is_given_once(spark, scratch):
    made = PB.Version(1, {"a=1": ["x"]})
    assert PB._created(spark, scratch, made) and not PB._created(spark, scratch, PB.Version(1, {"a=1": ["y"]}))
    assert PB.current(spark, scratch).parts == {"a=1": ["x"]}
    assert [f for f in os.listdir(f"{scratch}/_versions") if f.startswith(".new")] == []
    with pytest.raises(PB.Conflict):
        PB.publish(spark, scratch, PB.Version(), {"a=1": ["z"]})
    assert PB.publish(spark, scratch, PB.Version(), {"b=1": ["z"]}).parts == {"a=1": ["x"], "b=1": ["z"]}


def test_a_writer_that_dies_leaves_nothing_visible(spark, scratch, monkeypatch):
    SK.upsert_latest(spark, bars(spark, "A", "2024-01-01", 3), scratch, 1)
    with monkeypatch.context() as m:
        m.setattr(PB, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            SK.upsert_latest(spark, bars(spark, "A", "2024-01-02", 9), scratch)
    assert SK.read_prices(spark, scratch).count() == 3
    assert SK.upsert_latest(spark, bars(spark, "A", "2024-01-02", 9), scratch).changed == 9 - 0
    assert SK.read_prices(spark, scratch).count() == 10


def test_compaction_rewrites_small_files_only(spark, scratch):
    df = spark.range(0, 60_000, 1, 1).select("id", (F.col("id") % 2).alias("side"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    PB.append(df, scratch, ["side"])  # one large file a side
    for k in range(6):
        PB.append(df.filter(F.col("id") % 600 == k).withColumn("id", -F.col("id") - 1), scratch, ["side"])
    before = {r["name"]: r["length"] for r in PB.files(spark, scratch).collect()}
    large = {n for n, size in before.items() if size > 100_000}
    assert len(large) == 2 and len(before) == 8
    rows = sorted(tuple(r) for r in PB.read(spark, scratch).select("id", "side", "text").collect())
    old = PB.read(spark, scratch)
    done = PB.compact(spark, scratch, small=100_000, target=50_000, sort_by=["id"])
    after = {r["name"] for r in PB.files(spark, scratch).collect()}
    assert done == {"before": 8, "after": len(after), "rewritten": 6} and large < after and len(after) == 4
    assert sorted(tuple(r) for r in PB.read(spark, scratch).select("id", "side", "text").collect()) == rows
    assert old.count() == len(rows)  # a reader of the version before
    assert PB.compact(spark, scratch, small=100_000, target=50_000)["rewritten"] == 0
    removed = PB.vacuum(spark, scratch, keep=1)
    assert removed and PB.read(spark, scratch).count() == len(rows) and large <= {f[len(f"{scratch}/data/"):] for f in files_of(f"{scratch}/data")}


def test_bins_have_about_a_size(spark):
    listed = spark.createDataFrame([("a", f"f{k}", 10 + k) for k in range(20)] + [("b", "alone", 5), ("a", "big", 10_000)], "part string, name string, length long")
    own = {r["bin"]: r for r in PB.bins(listed, 1000, 60).groupBy("bin").agg(F.sum("length").alias("size"), F.count(F.lit(1)).alias("n")).collect()}
    assert all(r["n"] > 1 and r["size"] <= 60 + 29 for r in own.values()) and len(own) >= 5


def test_compaction_starts_again_when_its_partition_changes(spark, scratch, monkeypatch):
    df = spark.range(0, 100, 1, 1).select("id", F.lit(1).alias("side"))
    for k in range(3):
        PB.append(df.filter(F.col("id") % 3 == k), scratch, ["side"])
    real, calls = PB.stage, []

    def slow(*a):
        out = real(*a)
        calls.append(1)
        if len(calls) == 1:
            monkeypatch.setattr(PB, "stage", real)
            PB.append(df.withColumn("id", F.col("id") + 1000), scratch, ["side"])
        return out

    monkeypatch.setattr(PB, "stage", slow)
    PB.compact(spark, scratch)
    assert PB.read(spark, scratch).count() == 200 and PB.files(spark, scratch).count() == 1


# --- rolling state ---

def full(spark, prices_path, variant):
    return FE.create_features(C.clean(SK.read_prices(spark, prices_path)), variant, RUN)


def same(a, b):
    key = lambda df: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.select(sorted(df.columns)).collect())
    return key(a) == key(b)


@pytest.mark.parametrize("variant", ["intraday", "close_to_close"])
def test_rolling_equals_full_recompute(spark, scratch, variant, monkeypatch):
    """Days in order, a new ticker, a correction, a row that turns invalid, a batch with nothing new."""
    prices, feats, state = (f"{scratch}/{n}" for n in ("p", "f", "s"))
    nan = bars(spark, ["AA"], "2024-02-20", 1).withColumns({"close": F.lit(float("nan")), "ingestion_timestamp": F.lit(D("2024-03-02"))})
    batches = [
        (bars(spark, ["A", "AA", "AAA"], "2024-01-01", 50), {"ahead": 0, "late": 3}),
        (bars(spark, ["A", "AA"], "2024-02-20", 5), {"ahead": 2, "late": 0}),
        (bars(spark, ["A", "NEW"], "2024-02-25", 40), {"ahead": 1, "late": 1}),
        (bars(spark, ["A"], "2024-01-10", 2, close=99.0), {"ahead": 0, "late": 1}),
        (nan.unionByName(bars(spark, ["AAA"], "2024-04-01", 2)), {"ahead": 1, "late": 1}),
        (bars(spark, ["A"], "2024-02-25", 3), {"ahead": 0, "late": 0})]
    for batch, want in batches:
        done = SK.upsert_latest(spark, batch, prices, 2)
        assert RO.refresh_rolling(spark, prices, feats, state, done, RUN, variant, 2) == want
        assert same(SK.read_features(spark, feats), full(spark, prices, variant))
    assert PB.read(spark, state).groupBy("ticker").count().agg(F.max("count")).first()[0] == RO.LOOKBACK_ROWS


def test_a_day_reads_no_earlier_month(spark, scratch, monkeypatch):
    """The plans of an in-order day: price scans list the new month's partition folders only, features those too."""
    prices, feats, state = (f"{scratch}/{n}" for n in ("p", "f", "s"))
    done = SK.upsert_latest(spark, bars(spark, ["A", "B"], "2023-11-01", 100), prices, 2)
    RO.refresh_rolling(spark, prices, feats, state, done, RUN, n_buckets=2)
    done = SK.upsert_latest(spark, bars(spark, ["A", "B"], "2024-03-01", 1), prices)
    read = []
    real = PB.read
    monkeypatch.setattr(PB, "read", lambda spark, path, *a, **k: read.append((path, real(spark, path, *a, **k))) or read[-1][1])
    assert RO.refresh_rolling(spark, prices, feats, state, done, RUN) == {"ahead": 2, "late": 0}
    months = {f.split("month=")[1].split("/")[0] for path, df in read if df is not None and path != state for f in df.inputFiles()}
    assert months == {"2024-03"} and any(path == state for path, _ in read)
    assert same(SK.read_features(spark, feats), full(spark, prices, "close_to_close"))


def test_a_run_that_died_between_the_tables_is_made_up_for(spark, scratch, monkeypatch):
    prices, feats, state = (f"{scratch}/{n}" for n in ("p", "f", "s"))
    done = SK.upsert_latest(spark, bars(spark, ["A", "B"], "2024-01-01", 40), prices, 2)
    RO.refresh_rolling(spark, prices, feats, state, done, RUN, n_buckets=2)
    SK.upsert_latest(spark, bars(spark, ["A"], "2024-02-10", 3), prices)  # its refresh never ran
    done = SK.upsert_latest(spark, bars(spark, ["A", "B"], "2024-02-13", 1), prices)
    ran = RO.refresh_rolling(spark, prices, feats, state, done, RUN)
    assert ran["ahead"] == 0 and ran["late"] == 2
    assert same(SK.read_features(spark, feats), full(spark, prices, "close_to_close"))
    assert RO.refresh_rolling(spark, prices, feats, state, None, RUN) == {"ahead": 0, "late": 0}


# --- the daily job with a state ---

def landed(spark, path, df):
    df.select("ticker", F.col("date").alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
              F.col("close").alias("Close"), F.col("adj_close").alias("Adj Close"), F.col("volume").alias("Volume")).write.parquet(path)
    return path


def test_daily_run_with_a_state_equals_the_one_without(spark, scratch):
    """History, a day, a correction with a row that turns invalid, nothing new: same features, status and report both ways."""
    both = {name: [f"{scratch}/{name}-{t}" for t in ("prices", "features")] for name in ("plain", "state")}
    asked = ["A", "AA", "NOPE"]
    nan = bars(spark, ["AA"], "2024-02-05", 1).withColumn("close", F.lit(float("nan")))
    batches = [bars(spark, ["A", "AA", "OTHER"], "2024-01-01", 40), bars(spark, ["A", "AA"], "2024-02-10", 2),
               bars(spark, ["A"], "2024-01-20", 1, close=50.0).unionByName(nan)]
    refreshed = []
    for k, batch in enumerate([*batches, batches[-1]]):
        path = landed(spark, f"{scratch}/landing-{k}", batch)
        day = D("2024-06-01") + dt.timedelta(days=k)
        plain = DR.run_daily(spark, path, *both["plain"], day, asked, n_buckets=2)
        state = DR.run_daily(spark, path, *both["state"], day, asked, n_buckets=2, state_path=f"{scratch}/state")
        refreshed.append(state.refreshed)
        assert (state.changed_rows, state.rejected_rows) == (plain.changed_rows, plain.rejected_rows)
        drop = lambda p: SK.read_features(spark, p[1]).drop("feature_timestamp")  # noqa: E731 - a day's date, another one a rerun
        assert same(drop(both["state"]), drop(both["plain"]))
        for x, y in ((state.status, plain.status), (state.report, plain.report)):
            assert x.columns == y.columns and same(x, y)
    assert refreshed[:2] == [{"ahead": 0, "late": 2}, {"ahead": 2, "late": 0}] and refreshed[2] == {"ahead": 0, "late": 2}
    assert {r["ticker"]: r["status"] for r in state.status.collect()} == {"A": "processed", "AA": "processed", "NOPE": "failed"}


def test_the_reports_of_a_state_read_no_table(spark, scratch):
    path = landed(spark, f"{scratch}/landing", bars(spark, ["A", "B"], "2023-11-01", 100))
    ran = DR.run_daily(spark, path, f"{scratch}/p", f"{scratch}/f", RUN, n_buckets=2, state_path=f"{scratch}/s")
    status, report = DR.state_reports(spark, f"{scratch}/s", ran.status.select("ticker"))
    for df in (status, report):
        assert not [f for f in df.inputFiles() if f"{scratch}/p/" in f or f"{scratch}/f/" in f]
    assert ran.refreshed == {"ahead": 0, "late": 2} and ran.feature_rows is None


def test_a_daily_run_without_valid_rows(spark, scratch):
    path = landed(spark, f"{scratch}/landing", bars(spark, ["A"], "2024-01-01", 5).withColumn("close", F.lit(float("nan"))))
    ran = DR.run_daily(spark, path, f"{scratch}/p", f"{scratch}/f", RUN, n_buckets=2, state_path=f"{scratch}/s")
    assert [(r["status"], r["reason"]) for r in ran.status.collect()] == [("failed", "no_valid_rows")]
    assert [(r["table_exists"], r["passed"]) for r in ran.report.collect()] == [(False, False)]


def test_features_made_without_a_state_are_refused(spark, scratch):
    path = landed(spark, f"{scratch}/landing", bars(spark, ["A"], "2024-01-01", 5))
    DR.run_daily(spark, path, f"{scratch}/p", f"{scratch}/f", RUN, n_buckets=2)
    with pytest.raises(ValueError, match="without a state"):
        DR.run_daily(spark, path, f"{scratch}/p", f"{scratch}/f", RUN, n_buckets=2, state_path=f"{scratch}/s")


def test_stream_with_a_state(spark, scratch):
    """Two micro-batches over the rolling state equal a full recompute, and a rerun with nothing new changes nothing."""
    prices, feats, state, ckpt = (f"{scratch}/{n}" for n in ("p", "f", "s", "ckpt"))
    for k, batch in enumerate((bars(spark, ["A", "AA"], "2024-01-01", 40), bars(spark, ["A", "AA"], "2024-02-10", 2))):
        landed(spark, f"{scratch}/landing/part{k}", batch)
        for _ in range(2):
            q = ST.start_ingest(spark, f"{scratch}/landing/*", prices, ckpt, RUN, feats, n_buckets=2, state_path=state)
            q.awaitTermination(300)
            assert q.exception() is None
        assert same(SK.read_features(spark, feats), full(spark, prices, "close_to_close"))
    status, _ = DR.state_reports(spark, state, spark.createDataFrame([("A",), ("AA",)], "ticker string"))
    assert {(r["ticker"], r["rows_before"], r["feature_rows"]) for r in status.collect()} == {("A", 42, 41), ("AA", 42, 41)}
