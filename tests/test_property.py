"""Property tests: random small price histories (gaps, duplicate copies,
NULL/NaN prices) through Spark, checked against a plain pandas
implementation of the same rules."""
import datetime as dt
import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickwise.operators import asof as AS
from tickwise.operators import clean as C
from tickwise.operators import features as FE
from tickwise.schemas import PRICE_SCHEMA

RUN = dt.date(2024, 6, 1)
D0 = dt.date(2024, 1, 1)

price = st.one_of(st.floats(1.0, 500.0, allow_nan=False), st.just(float("nan")), st.none())
row = st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 60), price,
                st.floats(1.0, 500.0, allow_nan=False), st.integers(0, 2))


def to_frame(spark, rows):
    data = [(t, D0 + dt.timedelta(days=d), o, max(c, o or 0.0) + 1, 0.5, c, c, 100,
             D0 + dt.timedelta(days=100 + ing)) for t, d, o, c, ing in rows]
    return spark.createDataFrame(data, PRICE_SCHEMA)


def pandas_clean(rows):
    df = pd.DataFrame([(t, D0 + dt.timedelta(days=d), o, c, ing) for t, d, o, c, ing in rows],
                      columns=["ticker", "date", "open", "close", "ing"])
    df = df[df["open"].notna()]  # NULL and NaN both dropped
    df = df.sort_values(["ticker", "date", "ing", "close", "open"],
                        ascending=[True, True, False, False, False])
    return df.drop_duplicates(["ticker", "date"], keep="first").sort_values(["ticker", "date"])


def pandas_features(clean, variant):
    out = []
    for _, g in clean.groupby("ticker"):
        g = g.copy()
        if variant == "intraday":
            g["ret"] = (g["close"] - g["open"]) / g["open"]
            g["mom"] = g["close"] / g["close"].shift(7)
        else:
            prev = g["close"].shift(1)
            g["ret"] = (g["close"] - prev) / prev
            g["mom"] = (g["close"] - g["close"].shift(10)) / g["close"].shift(10)
        g["ma7"] = g["close"].rolling(7, min_periods=1).mean()
        g["ma30"] = g["close"].rolling(30, min_periods=1).mean()
        g["vol"] = g["ret"].rolling(7, min_periods=1).std(ddof=1)
        if variant == "close_to_close":
            g = g[g["ret"].notna()]
        out.append(g)
    if not out:
        return clean.iloc[0:0].assign(ret=[], mom=[], ma7=[], ma30=[], vol=[])
    return pd.concat(out)


def close_enough(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and not math.isnan(b) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=60), variant=st.sampled_from(FE.VARIANTS))
def test_clean_and_features_match_pandas(spark, rows, variant):
    got = FE.create_features(C.clean(to_frame(spark, rows)), variant, RUN).toPandas()
    want = pandas_features(pandas_clean(rows), variant)
    assert len(got) == len(want)
    got = got.sort_values(["ticker", "date"]).reset_index(drop=True)
    want = want.sort_values(["ticker", "date"]).reset_index(drop=True)
    for g_col, w_col in [("close", "close"), ("daily_return", "ret"), ("moving_avg_7", "ma7"),
                         ("moving_avg_30", "ma30"), ("volatility_7", "vol"), ("momentum", "mom")]:
        for a, b in zip(got[g_col], want[w_col]):
            a = None if a is None or (isinstance(a, float) and np.isnan(a)) else float(a)
            b = None if b is None or (isinstance(b, float) and np.isnan(b)) else float(b)
            assert close_enough(a, b), (variant, g_col, a, b)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=40),
       reqs=st.lists(st.tuples(st.sampled_from(["A", "B", "C", "Z"]), st.integers(-5, 70)),
                     min_size=1, max_size=30))
def test_asof_matches_merge_asof(spark, rows, reqs):
    feats = FE.create_features(C.clean(to_frame(spark, rows)), "intraday", RUN)
    req = spark.createDataFrame([(i, t, D0 + dt.timedelta(days=d)) for i, (t, d) in enumerate(reqs)],
                                "request_id long, ticker string, as_of_date date")
    got = {r["request_id"]: (r["feature_date"], r["close"], r["status"])
           for r in AS.asof_join(req, feats, ["close"]).collect()}
    f = feats.select("ticker", "date", "close").toPandas()
    f["date"] = pd.to_datetime(f["date"])
    r = pd.DataFrame([(i, t, pd.Timestamp(D0 + dt.timedelta(days=d))) for i, (t, d) in enumerate(reqs)],
                     columns=["request_id", "ticker", "as_of_date"]).sort_values("as_of_date")
    m = pd.merge_asof(r, f.sort_values("date").rename(columns={"date": "fdate"}),
                      left_on="as_of_date", right_on="fdate", by="ticker", direction="backward")
    known = set(f["ticker"])
    for _, x in m.iterrows():
        fd, cl, status = got[x["request_id"]]
        if pd.isna(x["fdate"]):
            assert fd is None and cl is None
            assert status == ("no_data_yet" if x["ticker"] in known else "no_ticker")
        else:
            assert fd == x["fdate"].date() and cl == x["close"] and status == "ok"
