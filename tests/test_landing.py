"""One bad file in the landing zone does not stop the others."""
import datetime as dt
import os

import pytest
from conftest import D
from pyspark.sql import functions as F

from tickwise.plans.daily_run import run_daily
from tickwise.sources import landing as LA
from tickwise.sources import prices as SP
from tickwise.sources import sinks as SK
from tickwise.streaming.ingest import start_ingest

HEADER = "ticker,Date,Open,High,Low,Close,Adj Close,Volume\n"
RUN = D("2024-02-01")


def bars(spark, ticker, n=40, start="2024-01-01"):
    first = D(start)
    rows = [(ticker, first + dt.timedelta(days=i), 1.0 + i, 2.0 + i, 0.5 + i, 1.5 + i, None, 10 + i) for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, Date date, Open double, High double, Low double, Close double, "
                                       "`Adj Close` double, Volume long").coalesce(1)


def part_of(folder):
    return next(os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet"))


def spoil(path, at=None, cut=None):
    with open(path, "rb") as f:
        data = bytearray(f.read())
    if cut:
        data = data[:int(len(data) * cut)]
    if at is not None:
        data[at:at + 60] = bytes(60)
    with open(path, "wb") as f:
        f.write(bytes(data))
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.replace(crc, crc + ".old")  # the checksum beside the file would name it broken as well


@pytest.fixture
def zone(spark, scratch):
    """Good files (odd names too), an empty one, and five bad ones."""
    bars(spark, "A").write.parquet(f"{scratch}/a b[1]+%20")
    bars(spark, "B").write.parquet(f"{scratch}/day=2")
    bars(spark, "E").limit(0).write.parquet(f"{scratch}/empty")
    for name in ("cut", "page"):
        bars(spark, "C").write.parquet(f"{scratch}/{name}")
    spoil(part_of(f"{scratch}/cut"), cut=0.5)
    spoil(part_of(f"{scratch}/page"), at=10)
    bars(spark, "C").withColumn("Date", F.lit("soon")).write.parquet(f"{scratch}/type")
    bars(spark, "C").select("Open", "Close").write.parquet(f"{scratch}/names")
    bars(spark, "C").select(F.col("ticker").alias("value")).write.text(f"{scratch}/text")
    return scratch


REASONS = {"cut": "no Parquet footer", "text": "no Parquet footer", "page": "of 40 rows", "type": "of 40 rows", "names": "no row has"}


def test_bad_files_are_named_and_the_rest_is_read(spark, zone):
    landed = LA.scan_landing_files(spark, zone, run_date=RUN)
    assert {(r["ticker"], r["n"]) for r in landed.rows.groupBy("ticker").agg(F.count(F.lit(1)).alias("n")).collect()} == {("A", 40), ("B", 40)}
    bad = {os.path.basename(os.path.dirname(r["path"])): r["reason"] for r in landed.files.filter("status = 'quarantined'").collect()}
    assert set(bad) == set(REASONS) and all(REASONS[k] in v for k, v in bad.items())
    assert LA.file_summary(landed.files).first().asDict() == {
        "files": 8, "ok_files": 2, "empty_files": 1, "quarantined_files": 5, "ok_rows": 80}
    req = spark.createDataFrame([("A",), ("C",)], "ticker string")
    status = {r["ticker"]: (r["status"], r["row_count"], r["bad_files"]) for r in SP.source_status(req, landed.rows, landed.files).collect()}
    assert status == {"A": ("ok", 40, 5), "C": ("failed", 0, 5)}


def test_quarantine_is_recorded_once_a_file(spark, zone, tmp_path_factory):
    table = str(tmp_path_factory.mktemp("q") / "quarantine")
    files = LA.probe_files(spark, zone)
    assert LA.record_quarantine(spark, files, table, RUN) == 5
    assert LA.record_quarantine(spark, LA.probe_files(spark, zone), table, D("2024-02-02")) == 0
    assert {r["found_on"] for r in spark.read.parquet(table).collect()} == {RUN}


def test_a_file_that_lands_after_the_probe_is_left_to_the_next_run(spark, scratch):
    bars(spark, "A").write.parquet(f"{scratch}/a")
    landed = LA.scan_landing_files(spark, scratch, run_date=RUN)
    bars(spark, "B").write.parquet(f"{scratch}/b")
    assert landed.rows.select("ticker").distinct().count() == 1


def test_all_bad_raises(spark, scratch, tmp_path_factory):
    bars(spark, "A").select("Open").write.parquet(f"{scratch}/a")
    out = str(tmp_path_factory.mktemp("t"))
    with pytest.raises(SP.MissingTableError):
        run_daily(spark, scratch, f"{out}/prices", f"{out}/features", RUN, quarantine_path=f"{out}/bad")
    assert spark.read.parquet(f"{out}/bad").count() == 1
    empty = str(tmp_path_factory.mktemp("none"))
    assert LA.scan_landing_files(spark, empty).rows.count() == 0


def test_daily_run_goes_on(spark, zone, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("t"))
    done = run_daily(spark, zone, f"{out}/prices", f"{out}/features", RUN, ["A", "B", "C"], n_buckets=2, quarantine_path=f"{out}/bad")
    assert done.changed_rows == 80
    assert {r["ticker"]: r["reason"] for r in done.status.collect()} == {"A": None, "B": None, "C": "no_data"}
    assert LA.file_summary(done.files).first()["quarantined_files"] == 5


def test_ticker_of_a_folder(spark, scratch):
    """A folder names the ticker of files without one; other files below the same root have their own."""
    bars(spark, "x").drop("ticker").write.parquet(f"{scratch}/ticker=BRK%2FB")
    bars(spark, "A").write.parquet(f"{scratch}/own")
    landed = LA.scan_landing_files(spark, scratch, run_date=RUN)
    assert {r["ticker"] for r in landed.rows.collect()} == {"BRK/B", "A"}
    assert {r["status"] for r in landed.files.collect()} == {"ok"}


def csv_zone(folder):
    for name, text in {
            "good.csv": HEADER + "A,2024-01-02 00:00:00+09:00,1,2,3,4,5,6\n",
            "foreign.csv": "x,y\n1,2\n", "swapped.csv": HEADER.replace("Open,High", "High,Open") + "A,2024-01-03,1,2,3,4,5,6\n",
            "header.csv": HEADER, "keys.csv": HEADER + ",,1,2,3,4,5,6\n", "quoted.csv": HEADER.replace("Adj Close", '"Adj Close"') + "B,2024-01-02,1,2,3,4,,6\n",
    }.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)


def test_csv_headers(spark, scratch):
    csv_zone(scratch)
    landed = LA.scan_landing_files(spark, scratch, "csv", RUN)
    assert {os.path.basename(r["path"]): r["status"] for r in landed.files.collect()} == {
        "good.csv": "ok", "quoted.csv": "ok", "header.csv": "empty", "foreign.csv": "quarantined", "swapped.csv": "quarantined", "keys.csv": "quarantined"}
    assert {(r["ticker"], str(r["date"]), r["adj_close"]) for r in landed.rows.collect()} == {("A", "2024-01-02", 5.0), ("B", "2024-01-02", 4.0)}


def test_foreign_header_of_a_file_in_many_parts(spark, scratch):
    """Spark compares the header in a file's first part only; the file is bad as a whole."""
    with open(f"{scratch}/big.csv", "w") as f:
        f.write("a,b,c,d,e,f,g,h\n" + "A,2024-01-02,1,2,3,4,5,6\n" * 4000)
    own = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        landed = LA.scan_landing_files(spark, scratch, "csv", RUN)
        assert landed.rows.count() == 0 and "foreign header" in landed.files.first()["reason"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", own)


def test_json_without_keys(spark, scratch):
    with open(f"{scratch}/a.json", "w") as f:
        f.write('{"ticker": "A", "Date": "2024-01-02T23:00:00-05:00", "Close": "4"}\n')
    with open(f"{scratch}/b.json", "w") as f:
        f.write("no json\n")
    landed = LA.scan_landing_files(spark, scratch, "json", RUN)
    assert [(r["ticker"], str(r["date"])) for r in landed.rows.collect()] == [("A", "2024-01-02")]
    assert LA.file_summary(landed.files).first()["quarantined_files"] == 1


def test_stream_goes_on(spark, zone, tmp_path_factory):
    """The same files by the stream; a second run with one more file reads that one only."""
    out = str(tmp_path_factory.mktemp("s"))

    def drain():
        q = start_ingest(spark, zone, f"{out}/prices", f"{out}/cp", RUN, n_buckets=2, quarantine_path=f"{out}/bad")
        q.awaitTermination()
    drain()
    assert SK.read_prices(spark, f"{out}/prices").groupBy("ticker").count().count() == 2
    assert spark.read.parquet(f"{out}/bad").count() == 5
    bars(spark, "Z").write.parquet(f"{zone}/late")
    drain()
    assert SK.read_prices(spark, f"{out}/prices").filter("ticker = 'Z'").count() == 40
    assert spark.read.parquet(f"{out}/bad").count() == 5


@pytest.mark.parametrize("text, day", [
    ("2024-01-02", "2024-01-02"), ("2024-01-02 00:00:00+09:00", "2024-01-02"), ("2024-01-02T23:59:59-05:00", "2024-01-02"),
    ("2024-01-02T00:00:00Z", "2024-01-02"), ("2024-01-02 00:00:00.000000+01:00", "2024-01-02"), ("soon", None), ("", None), (None, None)])
@pytest.mark.parametrize("zone_name", ["UTC", "Asia/Tokyo"])
def test_the_written_date_stays(spark, text, day, zone_name):
    own = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone_name)
    try:
        raw = spark.createDataFrame([("A", text, "1")], "ticker string, Date string, Close string")
        raw = raw.withColumns({c: F.lit("1") for c in ("Open", "High", "Low", "Volume")})
        got = SP.normalize_source(raw, RUN).first()["date"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", own)
    assert (None if got is None else str(got)) == day
