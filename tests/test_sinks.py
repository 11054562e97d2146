"""Writes: idempotent append, bucket overwrite, the daily run and the stream."""
import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickwise.operators import clean as C
from tickwise.plans import daily_run as DR
from tickwise.sources import fixtures as FX
from tickwise.sources import prices as SP
from tickwise.sources import published as PB
from tickwise.sources import sinks as SK
from tickwise.streaming import ingest as ST

RUN = dt.date(2002, 1, 1)


def landing_rows(spark):
    """Driver-derived bars in the landing-zone (source) column layout."""
    return FX.prices(spark, SF_SMALL).select(
        "ticker", F.col("date").alias("Date"), F.col("open").alias("Open"),
        F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
        F.col("adj_close").alias("Adj Close"), F.col("volume").alias("Volume"))


def table(spark, path):
    return spark.read.parquet(path)


def snapshot(df):
    """Rows as a sorted list (materialised before the files are replaced)."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_append_new_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "prices")
    p = FX.prices(spark, SF_SMALL)
    n = p.count()
    assert SK.append_new(spark, p, path) == n
    assert SK.append_new(spark, p, path) == 0
    assert table(spark, path).count() == n
    newer = p.limit(10).withColumn("ingestion_timestamp", F.lit(dt.date(2002, 1, 2))) \
             .withColumn("close", F.col("close") + 1)
    assert SK.append_new(spark, newer, path) == 10
    stored = table(spark, path)
    assert stored.count() == n + 10
    cleaned = C.clean(stored.select(*p.columns))
    assert cleaned.count() == n
    assert cleaned.filter(F.col("ingestion_timestamp") == dt.date(2002, 1, 2)).count() == 10


def upserted(spark, path):
    return SK.read_prices(spark, path)


def test_upsert_one_row_per_key_over_days(spark, scratch):
    """The same landing zone on three run dates: one row per key, the newest ingest."""
    path = os.path.join(scratch, "prices")
    p = FX.prices(spark, SF_SMALL)
    n = p.count()
    for d in (1, 2, 3):
        done = SK.upsert_latest(spark, p.withColumn("ingestion_timestamp", F.lit(dt.date(2002, 1, d))), path, 1)
        assert done.changed == n
        got = upserted(spark, path)
        assert got.count() == n and got.select("ingestion_timestamp").distinct().collect() == [(dt.date(2002, 1, d),)]
    late = SK.upsert_latest(spark, p.withColumn("ingestion_timestamp", F.lit(dt.date(2002, 1, 2))), path)
    assert late.changed == 0  # an older ingest doesn't replace a newer one


def test_upsert_correction_on_the_same_run_date_wins(spark, scratch):
    path = os.path.join(scratch, "prices")
    p = FX.prices(spark, SF_SMALL)
    SK.upsert_latest(spark, p, path, 1)
    fixed = p.filter(F.col("ticker") == "S1").withColumn("close", F.col("close") + 100)
    done = SK.upsert_latest(spark, fixed, path)
    assert done.changed == fixed.count() > 0
    got = upserted(spark, path)
    assert same(got.filter("ticker = 'S1'").select(*p.columns), fixed) and got.count() == p.count()
    before = sorted(os.listdir(os.path.join(path, os.listdir(path)[0])))
    again = SK.upsert_latest(spark, fixed, path)
    assert again.changed == 0 and again.first_dates.isEmpty()
    assert sorted(os.listdir(os.path.join(path, os.listdir(path)[0]))) == before


def test_upsert_rewrites_only_changed_partitions(spark, scratch):
    path = os.path.join(scratch, "prices")
    p = FX.prices(spark, SF_SMALL)
    SK.upsert_latest(spark, p, path, 1)
    one = p.filter((F.col("ticker") == "S1") & (F.col("date") >= dt.date(1997, 3, 1)) & (F.col("date") < dt.date(1997, 4, 1)))
    done = SK.upsert_latest(spark, one.withColumn("close", F.col("close") + 1), path)
    assert done.changed == one.count() > 0 and PB.changed_parts(done.base, done.made) == ["month=1997-03/ticker_bucket=0"]
    assert done.first_dates.collect()[0]["first_date"] == one.agg(F.min("date")).first()[0]


def test_upsert_rejects_rows_without_key_and_counts_them(spark, scratch):
    path = os.path.join(scratch, "prices")
    p = FX.prices(spark, SF_SMALL).limit(20)
    bad = p.withColumn("ticker", F.lit(None).cast("string")).unionByName(p.withColumn("date", F.lit(None).cast("date")))
    done = SK.upsert_latest(spark, p.unionByName(bad), path, 2)
    assert (done.changed, done.rejected) == (20, 40) and upserted(spark, path).count() == 20
    empty = SK.upsert_latest(spark, p.filter("false"), path)
    assert (empty.changed, empty.rejected) == (0, 0)


def test_bucket_count_is_stored_and_a_mismatch_refused(spark, scratch):
    import pytest
    path = os.path.join(scratch, "features")
    p = FX.prices(spark, SF_SMALL)
    SK.overwrite_buckets(p, path, 64)
    for call in (lambda: SK.overwrite_buckets(p, path, 7), lambda: SK.read_features(spark, path, ["S1"], 7),
                 lambda: SK.upsert_latest(spark, p, path, 7)):
        with pytest.raises(ValueError):
            call()
    assert SK.read_features(spark, path).count() == p.count()
    assert SK.overwrite_buckets(p, path) == p.count() and SK.read_features(spark, path).count() == p.count()


def test_overwrite_buckets_clears_a_bucket_without_rows(spark, scratch):
    path = os.path.join(scratch, "features")
    p = FX.prices(spark, SF_SMALL)
    SK.overwrite_buckets(p, path, 4)
    touched = SK.bucket_ids(p.filter("ticker = 'S1'"), 4)
    SK.overwrite_buckets(p.filter("false"), path, touched=touched)
    left = SK.read_features(spark, path)
    assert 0 < left.count() < p.count() and left.filter("ticker = 'S1'").count() == 0


def test_incremental_refresh_equals_full_recompute(spark, scratch):
    from tickwise.operators import features as FE
    from tickwise.plans import refresh as RF
    p = FX.prices(spark, SF_SMALL)
    for variant in ("intraday", "close_to_close"):
        prices_path, path = os.path.join(scratch, variant, "p"), os.path.join(scratch, variant, "f")
        wrong = p.withColumn("close", F.when(F.dayofmonth("date") == 9, F.col("close") * 2).otherwise(F.col("close")))
        some = p.filter((F.col("ticker") != "S2") & (F.col("date") > dt.date(1995, 5, 1)) & (F.crc32(F.col("ticker").cast("binary")) % 2 == 0))
        for batch in (wrong.filter(F.col("ticker") != "S3"), some, p):
            done = SK.upsert_latest(spark, batch, prices_path, 1)
            RF.refresh_features(spark, prices_path, path, done.first_dates, RUN, variant, 1)
            want = FE.create_features(C.clean(SK.read_prices(spark, prices_path)), variant, RUN)
            assert snapshot(SK.read_features(spark, path).select(*want.columns)) == snapshot(want)


def test_run_daily_loads_all_dates_and_later_corrections(spark, scratch):
    landing = os.path.join(scratch, "landing")
    rows = landing_rows(spark)
    rows.write.parquet(os.path.join(landing, "a"))
    args = (spark, os.path.join(landing, "*"), os.path.join(scratch, "p"), os.path.join(scratch, "f"))
    last = rows.agg(F.max("Date")).first()[0]
    r1 = DR.run_daily(*args, last, n_buckets=4)
    assert r1.changed_rows == rows.count() and upserted(spark, args[2]).count() == rows.count()
    rows.filter("ticker = 'S1'").withColumn("Close", F.col("Close") + 1).write.parquet(os.path.join(landing, "b"))
    r2 = DR.run_daily(spark, os.path.join(landing, "b"), *args[2:], last)
    n = rows.filter("ticker = 'S1'").count()
    assert r2.changed_rows == n and r2.feature_rows > 0
    feats = SK.read_features(spark, args[3])
    assert feats.count() == rows.count() - rows.select("ticker").distinct().count()
    closes = {r["date"]: r["close"] for r in feats.filter("ticker = 'S1'").collect()}
    first = rows.filter("ticker = 'S1'").agg(F.min("Date")).first()[0]
    assert closes == {r["Date"]: r["Close"] + 1 for r in rows.filter("ticker = 'S1'").collect() if r["Date"] != first}


def test_landing_files_without_a_column_do_not_hide_it(spark, scratch):
    path = os.path.join(scratch, "landing")
    rows = landing_rows(spark).filter("ticker in ('S1', 'S2')").withColumn("Adj Close", F.lit(5.0))
    rows.filter("ticker = 'S1'").drop("Adj Close").write.parquet(os.path.join(path, "a"))
    rows.filter("ticker = 'S2'").write.parquet(os.path.join(path, "b"))
    got = SP.scan_landing(spark, os.path.join(path, "*"), run_date=RUN)
    assert got.filter("ticker = 'S2' and adj_close = 5.0").count() == rows.filter("ticker = 'S2'").count()
    assert got.filter("ticker = 'S1' and adj_close = close").count() == rows.filter("ticker = 'S1'").count()


def test_csv_volume_with_a_zero_fraction(spark, scratch):
    rows = landing_rows(spark).filter("ticker = 'S1'")
    path = os.path.join(scratch, "csv")
    rows.withColumn("Volume", F.concat(F.col("Volume").cast("string"), F.lit(".0"))).write.option("header", "true").csv(path)
    got = SP.scan_landing(spark, path, "csv", run_date=RUN)
    assert C.clean(got).count() == rows.count() and got.filter("volume is null").count() == 0
    bad = SP.named_source(spark.createDataFrame([("T", "2024-01-01", "1", "x", "1", "2", "y", "1000.5")],
                                                SP.landing_schema("csv")), RUN)
    counts = {r["column_name"]: r["unparsed"] for r in C.unparsed_counts(bad).collect()}
    assert {k for k, n in counts.items() if n} == {"high", "adj_close", "volume"}


def test_csv_header_in_another_order_is_an_error(spark, scratch):
    import pytest
    rows = landing_rows(spark).filter("ticker = 'S1'")
    path = os.path.join(scratch, "csv")
    rows.select("Date", "ticker", "Close", "Open", "High", "Low", "Volume", "Adj Close").write.option("header", "true").csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        SP.scan_landing(spark, path, "csv", run_date=RUN).collect()


def test_extra_source_columns_are_kept(spark, scratch):
    from pyspark.sql.types import StringType, StructField, StructType
    path, prices_path = os.path.join(scratch, "landing"), os.path.join(scratch, "prices")
    rows = landing_rows(spark).filter("ticker in ('S1', 'S2')")
    SK.upsert_latest(spark, SP.normalize_source(rows, RUN), prices_path, 2)
    rows.filter("ticker = 'S2'").withColumn("exchange", F.lit("X")).write.parquet(path)
    extra = StructType([StructField("exchange", StringType())])
    SK.upsert_latest(spark, SP.scan_landing(spark, path, run_date=dt.date(2002, 1, 3), extra=extra), prices_path)
    got = upserted(spark, prices_path)
    assert {(r["ticker"], r["exchange"]) for r in got.collect()} == {("S1", None), ("S2", "X")}


def test_epoch_date_is_recorded_for_replays(spark, scratch):
    a = ST.epoch_date(spark, scratch, 3, dt.date(2024, 1, 1))
    assert a == dt.date(2024, 1, 1) and ST.epoch_date(spark, scratch, 3, dt.date(2024, 1, 9)) == a
    assert ST.epoch_date(spark, scratch, 4, dt.date(2024, 1, 9)) == dt.date(2024, 1, 9)


def test_absent_table_gives_failed_rows(spark):
    from tickwise.operators import quality as QA
    req = spark.createDataFrame([("S1",), ("S2",)], "ticker string")
    got = QA.validate_source(spark, SP.read_table(spark, "no_such_table_xyz", on_missing="skip"), req).collect()
    assert {(r["ticker"], r["table_exists"], r["passed"]) for r in got} == {("S1", False, False), ("S2", False, False)}


def test_checkpoint_folder_is_required_off_local(monkeypatch):
    import pytest
    from tickwise import session

    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_register_view_and_head_sample(spark):
    from tickwise.operators import profile as PR
    p = FX.prices(spark, SF_SMALL)
    assert spark.table(SP.register_view(p, "prices_probe")).count() == p.count()
    head = PR.head_sample(p)
    assert head.count() == 3 and head.exceptAll(p).count() == 0


def test_overwrite_buckets_replaces_only_touched(spark, scratch):
    path = os.path.join(scratch, "features")
    p = FX.prices(spark, SF_SMALL)
    SK.overwrite_buckets(p, path, n_buckets=4)
    before = PB.read(spark, path)
    b0 = before.filter("ticker_bucket = 0").select("ticker").distinct().collect()[0]["ticker"]
    part = p.filter(F.col("ticker") == b0).withColumn("close", F.lit(-1.0))
    SK.overwrite_buckets(part, path, n_buckets=4)
    after = PB.read(spark, path)
    assert same(after.filter("ticker_bucket != 0"), before.filter("ticker_bucket != 0"))
    assert after.filter("ticker_bucket = 0").select("ticker").distinct().count() == 1


def test_write_counted_matches(spark, scratch):
    p = FX.prices(spark, SF_SMALL)
    n = SK.overwrite_table(p, os.path.join(scratch, "t"))
    assert n == p.count()


def test_run_daily_end_to_end_and_rerun(spark, scratch):
    landing = os.path.join(scratch, "landing")
    landing_rows(spark).write.parquet(landing)
    prices_path, feats_path = os.path.join(scratch, "prices"), os.path.join(scratch, "features")
    tickers = ["S1", "S2", "S3", "NOPE"]
    r1 = DR.run_daily(spark, landing, prices_path, feats_path, RUN, tickers,
                      start=dt.date(1990, 1, 1), end=RUN, n_buckets=4)
    st = {r["ticker"]: r["status"] for r in r1.status.collect()}
    assert st == {"S1": "processed", "S2": "processed", "S3": "processed", "NOPE": "failed"}
    rep = {r["ticker"]: r["table_exists"] for r in r1.report.collect()}
    assert rep["NOPE"] is False and rep["S1"] is True
    p1, f1 = snapshot(table(spark, prices_path)), snapshot(table(spark, feats_path))
    r2 = DR.run_daily(spark, landing, prices_path, feats_path, RUN, tickers,
                      start=dt.date(1990, 1, 1), end=RUN, n_buckets=4)
    assert r2.changed_rows == 0 and r2.feature_rows == 0
    assert snapshot(table(spark, prices_path)) == p1
    assert snapshot(table(spark, feats_path)) == f1
    # a later run for other tickers keeps the features of S1..S3
    DR.run_daily(spark, landing, prices_path, feats_path, RUN, ["S4"],
                 start=dt.date(1990, 1, 1), end=RUN, n_buckets=4)
    f3 = table(spark, feats_path)
    for t in ["S1", "S2", "S3", "S4"]:
        assert f3.filter(F.col("ticker") == t).count() > 0


def test_scan_landing_csv_range(spark, scratch):
    landing = os.path.join(scratch, "csv")
    landing_rows(spark).write.option("header", "true").csv(landing)
    got = SP.scan_landing(spark, landing, "csv", run_date=dt.date(1998, 1, 1),
                          start=dt.date(1997, 1, 1), end=dt.date(1998, 1, 1), tickers=["S1"])
    want = SP.restrict(FX.prices(spark, SF_SMALL), dt.date(1997, 1, 1), dt.date(1998, 1, 1), ["S1"])
    assert got.count() == want.count() > 0
    assert got.agg(F.sum("volume")).collect()[0][0] == want.agg(F.sum("volume")).collect()[0][0]


def test_guarded_reads(spark, scratch):
    import pytest
    assert SP.read_path(spark, os.path.join(scratch, "nothing"), on_missing="skip") is None
    with pytest.raises(SP.MissingTableError):
        SP.read_path(spark, os.path.join(scratch, "nothing"))
    assert SP.read_table(spark, "no_such_table_xyz", on_missing="skip") is None


def test_stream_ingest_exactly_once(spark, scratch):
    landing = os.path.join(scratch, "landing")
    rows = landing_rows(spark)
    first = rows.filter(F.col("Date") < dt.date(1998, 1, 1))
    second = rows.filter(F.col("Date") >= dt.date(1998, 1, 1))
    first.write.parquet(os.path.join(landing, "part1"))
    prices_path = os.path.join(scratch, "prices")
    feats_path = os.path.join(scratch, "features")
    ckpt = os.path.join(scratch, "ckpt")
    src = os.path.join(landing, "*")
    q = ST.start_ingest(spark, src, prices_path, ckpt, RUN, feats_path, n_buckets=4)
    q.awaitTermination(300)
    assert SK.read_prices(spark, prices_path).count() == first.count()
    second.write.parquet(os.path.join(landing, "part2"))
    q = ST.start_ingest(spark, src, prices_path, ckpt, RUN, feats_path, n_buckets=4)
    q.awaitTermination(300)
    q = ST.start_ingest(spark, src, prices_path, ckpt, RUN, feats_path, n_buckets=4)
    q.awaitTermination(300)
    stored = SK.read_prices(spark, prices_path)
    assert stored.count() == rows.count()
    feats = SK.read_features(spark, feats_path)
    assert feats.count() == rows.count() - rows.select("ticker").distinct().count()


def test_save_as_table_typed_replace(spark):
    from tickwise.operators import features as FE
    from tickwise.schemas import FEATURE_SCHEMA
    clean = C.clean(FX.prices(spark, SF_SMALL))
    typed = FE.typed_features(FE.create_features(clean, "close_to_close", RUN))
    n = SK.save_as_table(typed, "features_typed_probe")
    assert n == typed.count()
    n2 = SK.save_as_table(typed.limit(5), "features_typed_probe")  # replace, not append
    back = SP.read_table(spark, "features_typed_probe")
    assert n2 == 5 and back.count() == 5
    assert [(f.name, f.dataType) for f in back.schema.fields] == \
           [(f.name, f.dataType) for f in FEATURE_SCHEMA.fields]


def test_run_daily_all_missing_raises(spark, scratch):
    import pytest
    landing = os.path.join(scratch, "landing")
    landing_rows(spark).write.parquet(landing)
    with pytest.raises(SP.MissingTableError):
        DR.run_daily(spark, landing, os.path.join(scratch, "p"), os.path.join(scratch, "f"), RUN,
                     ["NOPE1", "NOPE2"], start=dt.date(1990, 1, 1), end=RUN, n_buckets=4)


def test_scan_landing_json_matches_parquet(spark, scratch):
    rows = landing_rows(spark)
    rows.write.json(os.path.join(scratch, "json"))
    rows.write.parquet(os.path.join(scratch, "pq"))
    kw = dict(run_date=dt.date(1999, 1, 1), start=dt.date(1996, 1, 1), tickers=["S1", "S7"])
    a = SP.scan_landing(spark, os.path.join(scratch, "json"), "json", **kw)
    b = SP.scan_landing(spark, os.path.join(scratch, "pq"), "parquet", **kw)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_read_features_prunes_buckets(spark, scratch):
    path = os.path.join(scratch, "features")
    from tickwise.plans import registry as R
    f = R.features_c2c(spark, SF_SMALL)
    SK.overwrite_buckets(f, path, n_buckets=16)
    want = snapshot(f.filter(F.col("ticker").isin("S1", "S2")))
    by_list = SK.read_features(spark, path, ["S2", "S1", "S1"], n_buckets=16)
    assert snapshot(by_list.select(*f.columns)) == want
    plan = by_list._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ticker_bucket" in plan
    req = spark.createDataFrame([("S1",), ("S2",), ("NOPE",)], "ticker string")
    by_frame = SK.read_features(spark, path, req, n_buckets=16)
    assert snapshot(by_frame.select(*f.columns)) == want
    assert SK.read_features(spark, path).count() == f.count()
