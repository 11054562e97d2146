"""DuckDB SQL for every query key that has an SQL form.

The tables ``lineitem events orders supplier ...`` are views over the same
parquet files. Each text rebuilds the derived fixtures (``prices`` etc.) as
CTEs and then states the operator's semantics in plain SQL. Doubles that
come out of arithmetic are rounded to 6 places on both sides (window sums
may add in a different order in the two engines).
"""

from __future__ import annotations

# Rounding: DuckDB's round() on a double scales in binary and can land on
# the other side of a tie (10273.672812499999 -> ...813) where Spark rounds
# half-up from the shortest decimal text (-> ...812). Texts below write
# ROUND_TEXT(expression, places); ``expanded`` makes of it a rounding of the decimal
# parsed from the double's text. NaN and values outside DECIMAL(38,18) fall
# back to round().


def expanded(text: str) -> str:
    """Replace every ROUND_TEXT(expression, places), innermost first."""
    mark = "ROUND_TEXT("
    while (at := text.rfind(mark)) >= 0:
        begin = end = at + len(mark)
        depth = 1
        while depth:
            depth += (text[end] == "(") - (text[end] == ")")
            end += 1
        expr, places = text[begin:end - 1].rsplit(",", 1)
        text = (f"{text[:at]}coalesce(cast(round(try_cast(cast(({expr}) AS varchar) AS decimal(38,18)),{places}) AS double), "
                f"round({expr},{places})){text[end:]}")
    return text


# --- derived fixtures -------------------------------------------------------

PRICES = """prices AS (
  WITH t AS (
    SELECT concat('S', cast(l_suppkey AS varchar)) AS ticker,
           cast(l_shipdate AS date) AS date,
           l_extendedprice / l_quantity AS px, l_quantity AS qty,
           row_number() OVER (PARTITION BY l_suppkey, cast(l_shipdate AS date)
             ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS rn,
           count(*) OVER (PARTITION BY l_suppkey, cast(l_shipdate AS date)) AS n
    FROM lineitem)
  SELECT ticker, date, max(CASE WHEN rn = 1 THEN px END) AS open, max(px) AS high,
         min(px) AS low, max(CASE WHEN rn = n THEN px END) AS close,
         max(CASE WHEN rn = n THEN px END) AS adj_close,
         cast(sum(qty) AS bigint) AS volume, date '2002-01-01' AS ingestion_timestamp
  FROM t GROUP BY ticker, date)"""

EVENT_PRICES = """event_prices AS (
  WITH t AS (
    SELECT event_type AS ticker, cast(ts AS date) AS date, value AS px,
           row_number() OVER (PARTITION BY event_type, cast(ts AS date) ORDER BY ts, event_id) AS rn,
           count(*) OVER (PARTITION BY event_type, cast(ts AS date)) AS n
    FROM events)
  SELECT ticker, date, max(CASE WHEN rn = 1 THEN px END) AS open, max(px) AS high,
         min(px) AS low, max(CASE WHEN rn = n THEN px END) AS close,
         max(CASE WHEN rn = n THEN px END) AS adj_close,
         cast(count(*) AS bigint) AS volume, date '2002-01-01' AS ingestion_timestamp
  FROM t GROUP BY ticker, date)"""

PRICES_DIRTY = """prices_dirty AS (
  WITH b AS (
    SELECT *, (cast(substring(ticker, 2) AS bigint) * 7 + (date - DATE '1995-01-01')) % 10 AS pick,
           (date - DATE '1995-01-01') % 2 = 0 AS day_even
    FROM prices)
  SELECT ticker, date,
         CASE WHEN pick = 2 THEN -open WHEN pick = 3 THEN 0.0 ELSE open END AS open,
         high, low,
         CASE WHEN pick = 5 AND day_even THEN cast('NaN' AS double) ELSE close END AS close,
         CASE WHEN pick = 4 THEN NULL ELSE adj_close END AS adj_close,
         CASE WHEN pick = 1 THEN NULL ELSE volume END AS volume,
         ingestion_timestamp
  FROM b
  UNION ALL
  SELECT ticker, date, open, high, low, close + 1 AS close, adj_close, volume,
         DATE '2002-01-02' AS ingestion_timestamp
  FROM b WHERE pick = 0)"""


VALID = """date IS NOT NULL AND open IS NOT NULL AND NOT isnan(open)
      AND high IS NOT NULL AND NOT isnan(high) AND low IS NOT NULL AND NOT isnan(low)
      AND close IS NOT NULL AND NOT isnan(close) AND volume IS NOT NULL"""


def clean_of(src: str, name: str, drop_invalid: bool = True) -> str:
    """Drop NULL/NaN critical values, keep newest ingest per (ticker, date)."""
    where = f"WHERE {VALID}" if drop_invalid else ""
    return f"""{name} AS (
  SELECT ticker, date, open, high, low, close, adj_close, volume, ingestion_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY
             ingestion_timestamp DESC NULLS LAST, close DESC NULLS LAST, open DESC NULLS LAST,
             high DESC NULLS LAST, low DESC NULLS LAST, adj_close DESC NULLS LAST,
             volume DESC NULLS LAST) AS rn
    FROM {src}
    {where})
  WHERE rn = 1)"""


W = "PARTITION BY ticker ORDER BY date"


def features_intraday_of(src: str, name: str) -> str:
    return f"""{name}_base AS (
  SELECT ticker, date, open, high, low, close, cast(volume AS double) AS volume,
         (close - open) / nullif(open, 0) AS daily_return,
         avg(close) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7,
         avg(close) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS moving_avg_30,
         close / nullif(lag(close, 7) OVER ({W}), 0) AS momentum
  FROM {src}),
{name} AS (
  SELECT ticker, date, open, high, low, close, volume, daily_return, moving_avg_7, moving_avg_30,
         stddev_samp(daily_return) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS volatility_7,
         momentum, DATE '2002-01-01' AS feature_timestamp
  FROM {name}_base)"""


def features_c2c_of(src: str, name: str) -> str:
    return f"""{name}_lag AS (
  SELECT ticker, date, open, high, low, close, volume,
         lag(close, 1) OVER ({W}) AS prev_close, lag(close, 10) OVER ({W}) AS close_10
  FROM {src}),
{name}_base AS (
  SELECT *, (close - prev_close) / nullif(prev_close, 0) AS daily_return,
         avg(close) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7,
         avg(close) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS moving_avg_30,
         (close - close_10) / nullif(close_10, 0) AS momentum
  FROM {name}_lag),
{name} AS (
  SELECT ticker, date, open, high, low, close, volume, daily_return, moving_avg_7, moving_avg_30,
         volatility_7, momentum, feature_timestamp FROM (
    SELECT *, stddev_samp(daily_return) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS volatility_7,
           DATE '2002-01-01' AS feature_timestamp
    FROM {name}_base)
  WHERE daily_return IS NOT NULL)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


R6 = "ROUND_TEXT({c}, 6) AS {c}"


def rounded(cols: list[str]) -> str:
    return ", ".join(R6.format(c=c) for c in cols)


FEATURE_DOUBLES = ["daily_return", "moving_avg_7", "moving_avg_30", "volatility_7", "momentum"]
FEATURE_SELECT = ("ticker, date, open, high, low, close, volume, "
                  + rounded(FEATURE_DOUBLES) + ", feature_timestamp")

PRICES_CLEAN = clean_of("prices", "prices_clean")
FEAT_I = features_intraday_of("prices_clean", "feat")
FEAT_C = features_c2c_of("prices_clean", "feat")

SQL: dict[str, str] = {}

SQL["f_features_intraday"] = with_(PRICES, PRICES_CLEAN, FEAT_I) + f"SELECT {FEATURE_SELECT} FROM feat"

REQUESTS = """requests AS (
  WITH o AS (
    SELECT o_orderkey AS request_id,
           'S' || cast(o_custkey % (SELECT count(*) + 2 FROM supplier) AS varchar) AS ticker,
           cast(o_orderdate AS date) AS as_of_date
    FROM orders)
  SELECT request_id, ticker, as_of_date FROM o
  UNION ALL
  SELECT -request_id AS request_id, ticker, as_of_date - 30 AS as_of_date
  FROM o WHERE as_of_date < DATE '1995-02-01')"""

EVENT_CLEAN = clean_of("event_prices", "event_clean")
PRICES_COLS = "ticker, date, open, high, low, close, adj_close, volume, ingestion_timestamp"


def pct(n: str, total: str) -> str:
    return f"coalesce(cast({n} AS double) * 100 / nullif({total}, 0), 0.0)"


# --- sources ------------------------------------------------------------------

SQL["p_source_range"] = with_(PRICES) + (
    "SELECT * FROM prices WHERE date >= DATE '1997-01-01' AND date < DATE '1998-01-01'")
SQL["p_source_status"] = with_(PRICES, REQUESTS) + """, st AS (
SELECT t.ticker, CASE WHEN c.n > 0 THEN 'ok' ELSE 'failed' END AS status,
       cast(coalesce(c.n, 0) AS bigint) AS row_count
FROM (SELECT DISTINCT ticker FROM requests) t
LEFT JOIN (SELECT ticker, count(*) AS n FROM prices GROUP BY ticker) c ON t.ticker = c.ticker)
SELECT ticker, status, row_count,
       (SELECT cast(coalesce(sum(row_count), 0) AS bigint) FROM st) AS total_rows
FROM st"""
SQL["p_rename"] = with_(PRICES) + f"SELECT {PRICES_COLS} FROM prices"
SQL["p_adj_close"] = with_(PRICES, PRICES_DIRTY) + """
SELECT ticker, date, open, high, low, close, coalesce(adj_close, close) AS adj_close, volume,
       ingestion_timestamp FROM prices_dirty"""
SQL["p_typed_projection"] = with_(PRICES, PRICES_DIRTY) + f"SELECT {PRICES_COLS} FROM prices_dirty"
SQL["p_ticker_filter"] = with_(PRICES) + "SELECT * FROM prices WHERE ticker = 'S1'"
SQL["p_project"] = with_(PRICES) + "SELECT ticker, date, open, high, low, close, volume FROM prices"

# --- cleaning -------------------------------------------------------------------

SQL["p_dropna"] = with_(PRICES, PRICES_DIRTY) + f"SELECT * FROM prices_dirty WHERE {VALID}"
SQL["p_dedup"] = with_(PRICES, PRICES_DIRTY, clean_of("prices_dirty", "d", False)) + "SELECT * FROM d"
SQL["p_clean"] = with_(PRICES, PRICES_DIRTY, clean_of("prices_dirty", "d")) + "SELECT * FROM d"
SQL["p_clean_sorted"] = with_(PRICES, PRICES_DIRTY, clean_of("prices_dirty", "d")) + (
    "SELECT * FROM d ORDER BY ticker, date")
SQL["p_clean_counts"] = with_(PRICES, PRICES_DIRTY) + f"""
SELECT ticker, count(*) AS rows_before,
       count(DISTINCT date) FILTER (WHERE {VALID}) AS rows_after,
       count(*) - count(DISTINCT date) FILTER (WHERE {VALID}) AS rows_removed
FROM prices_dirty GROUP BY ticker"""
SQL["p_negative_prices"] = with_(PRICES, PRICES_DIRTY) + """
SELECT ticker, count(*) AS rows, count(*) FILTER (WHERE close < 0 OR open < 0) AS negative_rows
FROM prices_dirty GROUP BY ticker"""

# --- profiling ------------------------------------------------------------------

SQL["p_symbol_counts"] = with_(PRICES) + """
SELECT ticker, count(*) AS record_count, min(date) AS first_date, max(date) AS last_date
FROM prices GROUP BY ticker"""
SQL["p_record_counts"] = with_(PRICES) + "SELECT ticker, count(*) AS record_count FROM prices GROUP BY ticker"
SQL["p_date_coverage"] = with_(PRICES) + """
SELECT ticker, min(date) AS start_date, max(date) AS end_date, count(DISTINCT date) AS trading_days,
       cast(max(date) - min(date) AS integer) AS total_days
FROM prices GROUP BY ticker"""
SQL["p_gaps"] = with_(PRICES) + """, d AS (SELECT DISTINCT ticker, date FROM prices),
l AS (SELECT ticker, date, lag(date) OVER (PARTITION BY ticker ORDER BY date) AS prev FROM d)
SELECT ticker, date AS gap_end, prev AS gap_start, cast(date - prev AS integer) AS days_gap
FROM l WHERE date - prev > 1"""
SQL["p_null_counts"] = with_(PRICES, PRICES_DIRTY) + "SELECT ticker, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in
    ["date", "open", "high", "low", "close", "adj_close", "volume", "ingestion_timestamp"]
) + " FROM prices_dirty GROUP BY ticker"
SQL["p_total_rows"] = with_(PRICES) + "SELECT count(*) AS total_rows FROM prices"
SQL["p_recent5"] = with_(PRICES) + "SELECT * FROM prices ORDER BY date DESC, ticker LIMIT 5"
SQL["p_recent10"] = with_(PRICES) + "SELECT * FROM prices ORDER BY date DESC, ticker LIMIT 10"

# --- features -------------------------------------------------------------------

SQL["f_features_intraday_events"] = (with_(EVENT_PRICES, EVENT_CLEAN,
                                           features_intraday_of("event_clean", "feat"))
                                     + f"SELECT {FEATURE_SELECT} FROM feat")
SQL["f_features_c2c"] = with_(PRICES, PRICES_CLEAN, FEAT_C) + f"SELECT {FEATURE_SELECT} FROM feat"
SQL["f_typed_projection"] = with_(PRICES, PRICES_CLEAN, FEAT_C) + (
    "SELECT ticker, date, open, high, low, close, cast(volume AS double) AS volume, "
    + rounded(FEATURE_DOUBLES) + ", feature_timestamp FROM feat")
SQL["f_moving_avg_7"] = with_(PRICES, PRICES_CLEAN) + f"""
SELECT ticker, date, close,
       ROUND_TEXT(avg(close) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg_7
FROM prices_clean"""
SQL["f_moving_avg_30"] = with_(PRICES, PRICES_CLEAN) + f"""
SELECT ticker, date, close,
       ROUND_TEXT(avg(close) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS moving_avg_30
FROM prices_clean"""
SQL["f_volatility_7"] = with_(EVENT_PRICES, EVENT_CLEAN) + f""", r AS (
  SELECT ticker, date, (close - open) / nullif(open, 0) AS daily_return FROM event_clean)
SELECT ticker, date, ROUND_TEXT(daily_return, 6) AS daily_return,
       ROUND_TEXT(stddev_samp(daily_return) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS volatility_7
FROM r"""
SQL["f_daily_return_c2c"] = with_(PRICES, PRICES_CLEAN) + f"""
SELECT ticker, date, close,
       ROUND_TEXT((close - lag(close) OVER ({W})) / nullif(lag(close) OVER ({W}), 0), 6) AS daily_return
FROM prices_clean"""
SQL["f_momentum_ratio7"] = with_(PRICES, PRICES_CLEAN) + f"""
SELECT ticker, date, close, ROUND_TEXT(close / nullif(lag(close, 7) OVER ({W}), 0), 6) AS momentum
FROM prices_clean"""
SQL["f_momentum_return10"] = with_(PRICES, PRICES_CLEAN) + f"""
SELECT ticker, date, close,
       ROUND_TEXT((close - lag(close, 10) OVER ({W})) / nullif(lag(close, 10) OVER ({W}), 0), 6) AS momentum
FROM prices_clean"""
SQL["f_union_all"] = with_(PRICES, PRICES_CLEAN, FEAT_C, EVENT_PRICES, EVENT_CLEAN,
                           features_c2c_of("event_clean", "efeat")) + (
    f"SELECT {FEATURE_SELECT} FROM feat UNION ALL SELECT {FEATURE_SELECT} FROM efeat")
SQL["f_recent5_per_ticker"] = with_(PRICES, PRICES_CLEAN, FEAT_C) + f"""
SELECT {FEATURE_SELECT} FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM feat)
WHERE rn <= 5"""

# --- labels and split -------------------------------------------------------------

TRAIN_READ = """train_read AS (
  SELECT ticker, date, close, daily_return, moving_avg_7, moving_avg_30, volatility_7, momentum
  FROM feat WHERE close IS NOT NULL AND daily_return IS NOT NULL)"""
LABELED = f"""labeled AS (
  SELECT ticker, date, close, daily_return, moving_avg_7, moving_avg_30, volatility_7, momentum,
         CASE WHEN next_close > close THEN 1 ELSE 0 END AS next_day_up
  FROM (SELECT *, lead(close) OVER ({W}) AS next_close FROM train_read)
  WHERE next_close IS NOT NULL)"""
SPLIT_BOUNDS = """bounds AS (
  SELECT min(date) AS min_date, max(date) AS max_date,
         min(date) + cast(floor((max(date) - min(date)) * 0.8) AS integer) AS split_date
  FROM labeled)"""
LAB = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ, LABELED)

SQL["f_training_read"] = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ) + (
    "SELECT ticker, date, close, " + rounded(FEATURE_DOUBLES) + " FROM train_read")
SQL["f_labels"] = LAB + ("SELECT ticker, date, close, " + rounded(FEATURE_DOUBLES)
                         + ", next_day_up FROM labeled")
SQL["f_label_distribution"] = LAB + "SELECT next_day_up, count(*) AS count FROM labeled GROUP BY next_day_up"
SQL["f_split_date"] = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ, LABELED, SPLIT_BOUNDS) + (
    "SELECT min_date, max_date, split_date FROM bounds")
SQL["f_split"] = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ, LABELED, SPLIT_BOUNDS) + """
SELECT ticker, date, next_day_up,
       CASE WHEN date <= (SELECT split_date FROM bounds) THEN 'train' ELSE 'test' END AS split
FROM labeled"""

# --- quality -----------------------------------------------------------------------

FT = with_(PRICES, PRICES_CLEAN, FEAT_C)
FEAT_COLS_NO_TICKER = ["date", "open", "high", "low", "close", "volume"] + FEATURE_DOUBLES + ["feature_timestamp"]
OUTLIER_RULES = [  # feature, extreme, moderate, two-sided (close-to-close momentum bounds)
    ("daily_return", 0.2, 0.1, True), ("volatility_7", 0.5, 0.3, False), ("momentum", 1.0, 0.5, False)]


def outside(f: str, t: float, two_sided: bool) -> str:
    return f"({f} < -{t} OR {f} > {t})" if two_sided else f"{f} > {t}"


SQL["f_schema_check"] = FT + """
SELECT DISTINCT ticker, cast(13 AS bigint) AS column_count, '' AS missing_columns,
       '' AS extra_columns, true AS columns_ok FROM feat"""
SQL["f_null_counts"] = FT + "SELECT ticker, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in FEAT_COLS_NO_TICKER) + " FROM feat GROUP BY ticker"

NULL_LONG = """null_long AS (""" + "\n  UNION ALL ".join(
    f"SELECT ticker, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS total "
    f"FROM feat GROUP BY ticker" for c in FEAT_COLS_NO_TICKER) + ")"
NULL_REPORT = f"""null_report AS (
  SELECT ticker, column_name, null_count, {pct('null_count', 'total')} AS null_pct FROM null_long)"""
SQL["f_null_bands"] = FT + ", " + NULL_LONG + ", " + NULL_REPORT + """
SELECT ticker, column_name, null_count, ROUND_TEXT(null_pct, 6) AS null_pct,
       CASE WHEN null_pct > 5.0 THEN 'fail' WHEN null_pct > 1.0 THEN 'warn' ELSE 'ok' END AS band
FROM null_report"""
SQL["f_completeness"] = FT + ", c AS (" + "\n  UNION ALL ".join(
    f"SELECT ticker, '{f}' AS feature, count({f}) AS non_null, count(*) AS total FROM feat GROUP BY ticker"
    for f in FEATURE_DOUBLES) + f""")
SELECT ticker, feature, non_null, ROUND_TEXT({pct('non_null', 'total')}, 6) AS completeness_pct,
       CASE WHEN {pct('non_null', 'total')} >= 95.0 THEN 'good'
            WHEN {pct('non_null', 'total')} >= 80.0 THEN 'fair' ELSE 'poor' END AS band
FROM c"""
SQL["f_date_range"] = FT + """
SELECT ticker, min(date) AS min_date, max(date) AS max_date, count(date) AS total_days
FROM feat GROUP BY ticker"""
SQL["f_feature_ranges"] = FT + "\n  UNION ALL ".join(
    f"SELECT ticker, '{f}' AS feature, ROUND_TEXT(min({f}), 6) AS min_val, ROUND_TEXT(max({f}), 6) AS max_val, "
    f"ROUND_TEXT(avg({f}), 6) AS avg_val FROM feat GROUP BY ticker"
    for f in ["daily_return", "volatility_7", "momentum"])
SQL["f_summary"] = FT + "\n  UNION ALL ".join(
    f"SELECT ticker, '{f}' AS feature, count({f}) AS count, ROUND_TEXT(avg({f}), 6) AS mean, "
    f"ROUND_TEXT(stddev_samp({f}), 6) AS stddev, ROUND_TEXT(min({f}), 6) AS min, "
    f"ROUND_TEXT(quantile_cont({f}, 0.25), 6) AS p25, ROUND_TEXT(quantile_cont({f}, 0.5), 6) AS p50, "
    f"ROUND_TEXT(quantile_cont({f}, 0.75), 6) AS p75, ROUND_TEXT(max({f}), 6) AS max FROM feat GROUP BY ticker"
    for f in FEATURE_DOUBLES)
SQL["f_outlier_counts"] = FT + ", o AS (" + "\n  UNION ALL ".join(
    f"SELECT ticker, '{f}' AS feature, count(*) FILTER (WHERE {outside(f, e, two)}) AS extreme_count, "
    f"count(*) FILTER (WHERE {outside(f, m, two)}) AS moderate_count, count(*) AS total "
    f"FROM feat GROUP BY ticker" for f, e, m, two in OUTLIER_RULES) + f""")
SELECT ticker, feature, extreme_count, ROUND_TEXT({pct('extreme_count', 'total')}, 6) AS extreme_pct,
       moderate_count, ROUND_TEXT({pct('moderate_count', 'total')}, 6) AS moderate_pct,
       {pct('extreme_count', 'total')} > 1.0 AS high_rate
FROM o"""
SQL["f_return_outliers"] = FT + f"SELECT {FEATURE_SELECT} FROM feat WHERE daily_return < -0.2 OR daily_return > 0.2"
VERDICT = f"""verdict AS (
  SELECT ticker, rows, extreme_outliers, {pct('extreme_outliers', 'rows')} AS outlier_pct,
         {pct('extreme_outliers', 'rows')} < 1.0 AS outlier_ok
  FROM (SELECT ticker, count(*) AS rows,
               count(*) FILTER (WHERE daily_return < -0.2 OR daily_return > 0.2) AS extreme_outliers
        FROM feat GROUP BY ticker))"""
SQL["f_outlier_verdict"] = FT + ", " + VERDICT + """
SELECT ticker, rows, extreme_outliers, ROUND_TEXT(outlier_pct, 6) AS outlier_pct, outlier_ok FROM verdict"""
SQL["f_top_outliers"] = FT + f"""
SELECT date, ticker, {rounded(['daily_return'])}, close, n_extreme FROM (
  SELECT date, ticker, daily_return, close, count(*) OVER (PARTITION BY ticker) AS n_extreme,
         row_number() OVER (PARTITION BY ticker ORDER BY daily_return DESC, date DESC) AS rn
  FROM feat WHERE daily_return < -0.2 OR daily_return > 0.2)
WHERE rn <= 10"""
REPORT = f"""report AS (
  SELECT t.ticker, v.rows IS NOT NULL AS table_exists, cast(coalesce(v.rows, 0) AS bigint) AS row_count,
         cast(CASE WHEN v.rows IS NOT NULL THEN 13 ELSE 0 END AS bigint) AS column_count,
         v.rows IS NOT NULL AS columns_ok,
         coalesce(nv.null_ok, false) AS null_ok, coalesce(v.outlier_ok, false) AS outlier_ok,
         cast(coalesce(v.extreme_outliers, 0) AS bigint) AS extreme_outliers,
         coalesce(nv.high_null_columns, '') AS high_null_columns,
         v.rows IS NOT NULL AND coalesce(nv.null_ok, false) AND coalesce(v.outlier_ok, false) AS passed
  FROM (SELECT DISTINCT ticker FROM requests) t
  LEFT JOIN verdict v ON t.ticker = v.ticker
  LEFT JOIN (SELECT ticker, coalesce(string_agg(CASE WHEN null_pct > 5.0 THEN column_name END, ',' ORDER BY column_name), '')
                        AS high_null_columns,
                    count(*) FILTER (WHERE null_pct > 5.0) = 0 AS null_ok
             FROM null_report GROUP BY ticker) nv ON t.ticker = nv.ticker)"""
REPORT_CTES = FT + ", " + REQUESTS + ", " + VERDICT + ", " + NULL_LONG + ", " + NULL_REPORT + ", " + REPORT
SQL["f_validation_report"] = REPORT_CTES + "\nSELECT * FROM report"
SQL["f_validation_summary"] = REPORT_CTES + """
SELECT count(*) FILTER (WHERE table_exists) AS tables_validated,
       count(*) FILTER (WHERE table_exists AND passed) AS tables_passed,
       count(*) FILTER (WHERE table_exists AND NOT passed) AS tables_failed,
       cast(coalesce(sum(row_count) FILTER (WHERE table_exists), 0) AS bigint) AS total_rows,
       ROUND_TEXT(coalesce(cast(sum(column_count) FILTER (WHERE table_exists) AS double)
             / greatest(count(*) FILTER (WHERE table_exists), 1), 0.0), 6) AS avg_columns,
       cast(coalesce(sum(extreme_outliers) FILTER (WHERE table_exists), 0) AS bigint) AS total_outliers,
       coalesce(bool_and(passed), true) AS all_passed
FROM report"""
SQL["f_verify_return"] = FT + f"""
SELECT ticker, date, close, ROUND_TEXT(daily_return, 6) AS daily_return, prev_close,
       ROUND_TEXT(calculated_return, 6) AS calculated_return FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM (
    SELECT ticker, date, close, daily_return, lag(close) OVER ({W}) AS prev_close,
           ROUND_TEXT((close - lag(close) OVER ({W})) / nullif(lag(close) OVER ({W}), 0), 6) AS calculated_return,
           max(date) OVER (PARTITION BY ticker) AS last_date
    FROM feat)
  WHERE date >= last_date - 7)
WHERE rn <= 5"""
SQL["f_verify_ma7"] = FT + f"""
SELECT ticker, date, close, ROUND_TEXT(moving_avg_7, 6) AS moving_avg_7, ROUND_TEXT(moving_avg_30, 6) AS moving_avg_30,
       calculated_ma7 FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM (
    SELECT ticker, date, close, moving_avg_7, moving_avg_30,
           ROUND_TEXT(avg(close) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS calculated_ma7,
           max(date) OVER (PARTITION BY ticker) AS last_date
    FROM feat)
  WHERE date >= last_date - 10)
WHERE rn <= 5"""

# --- as-of ---------------------------------------------------------------------------

SQL["f_asof_latest"] = FT + f"""
SELECT {FEATURE_SELECT} FROM feat WHERE ticker = 'S1' AND date <= DATE '1998-06-30'
ORDER BY date DESC LIMIT 1"""
SQL["f_asof_join"] = with_(PRICES, PRICES_CLEAN, FEAT_C, REQUESTS) + """
SELECT r.request_id, r.ticker, r.as_of_date,
       CASE WHEN f.date IS NOT NULL THEN 'ok'
            WHEN r.ticker IN (SELECT ticker FROM feat) THEN 'no_data_yet' ELSE 'no_ticker' END AS status,
       f.date AS feature_date, f.close, ROUND_TEXT(f.daily_return, 6) AS daily_return,
       ROUND_TEXT(f.moving_avg_7, 6) AS moving_avg_7, ROUND_TEXT(f.moving_avg_30, 6) AS moving_avg_30,
       ROUND_TEXT(f.volatility_7, 6) AS volatility_7, ROUND_TEXT(f.momentum, 6) AS momentum
FROM requests r ASOF LEFT JOIN feat f ON r.ticker = f.ticker AND r.as_of_date >= f.date"""

# --- ML ------------------------------------------------------------------------------

COMPLETE = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATURE_DOUBLES)
SQL["m_assembled_count"] = LAB + f"SELECT count(*) AS assembled_rows FROM labeled WHERE {COMPLETE}"
SQL["m_scaled_features"] = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ, LABELED, SPLIT_BOUNDS) + f""",
comp AS (SELECT * FROM labeled WHERE {COMPLETE}),
st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FEATURE_DOUBLES)}
       FROM comp WHERE date <= (SELECT split_date FROM bounds))
SELECT ticker, date, {", ".join(f"ROUND_TEXT(({c} - m_{c}) / s_{c}, 6) AS scaled_{c}" for c in FEATURE_DOUBLES)}
FROM comp, st"""

# --- daily run status ----------------------------------------------------------------

RUN_CTES = with_(PRICES, PRICES_DIRTY, REQUESTS, clean_of("prices_dirty", "dclean"),
                 features_c2c_of("dclean", "dfeat")) + """, status AS (
  SELECT t.ticker, cast(coalesce(b.n, 0) AS bigint) AS rows_before,
         cast(coalesce(a.n, 0) AS bigint) AS rows_after,
         cast(coalesce(f.n, 0) AS bigint) AS feature_rows,
         CASE WHEN coalesce(f.n, 0) > 0 THEN 'processed' ELSE 'failed' END AS status,
         CASE WHEN coalesce(f.n, 0) > 0 THEN NULL
              WHEN coalesce(b.n, 0) = 0 THEN 'no_data'
              WHEN coalesce(a.n, 0) = 0 THEN 'no_valid_rows' ELSE 'no_features' END AS reason
  FROM (SELECT DISTINCT ticker FROM requests) t
  LEFT JOIN (SELECT ticker, count(*) AS n FROM prices_dirty GROUP BY ticker) b ON t.ticker = b.ticker
  LEFT JOIN (SELECT ticker, count(*) AS n FROM dclean GROUP BY ticker) a ON t.ticker = a.ticker
  LEFT JOIN (SELECT ticker, count(*) AS n FROM dfeat GROUP BY ticker) f ON t.ticker = f.ticker)
"""
SQL["f_run_status"] = RUN_CTES + "SELECT * FROM status"
SQL["f_run_summary"] = RUN_CTES + """
SELECT count(*) FILTER (WHERE status = 'processed') AS processed,
       count(*) FILTER (WHERE status = 'failed') AS failed,
       cast(coalesce(sum(feature_rows), 0) AS bigint) AS total_feature_rows
FROM status"""

# --- sinks ---------------------------------------------------------------------------

SQL["k_append_twice"] = with_(PRICES) + f"SELECT {PRICES_COLS} FROM prices"
SQL["k_features_buckets"] = with_(PRICES, PRICES_CLEAN, FEAT_C) + f"SELECT {FEATURE_SELECT} FROM feat"


def corrected(src: str) -> str:
    return (f"SELECT ticker, date, open, high, low, close + 100 AS close, adj_close, volume, DATE '2002-01-02' AS "
            f"ingestion_timestamp FROM {src} WHERE day(date) = 15")


SQL["k_upsert_days"] = with_(PRICES, PRICES_DIRTY) + f"""
SELECT {PRICES_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY ingestion_timestamp DESC, load DESC) AS rn
  FROM (SELECT {PRICES_COLS}, 1 AS load FROM prices_dirty UNION ALL SELECT {PRICES_COLS}, 2 FROM ({corrected('prices')})))
WHERE rn = 1"""
SQL["k_evolve"] = with_(PRICES) + f"""
SELECT {PRICES_COLS}, NULL AS exchange FROM prices WHERE day(date) <> 15
UNION ALL SELECT {PRICES_COLS}, 'X' || ticker FROM ({corrected('prices')})"""
SQL["k_rebucket"] = with_(PRICES, PRICES_CLEAN, FEAT_C) + f"SELECT {FEATURE_SELECT}, 2 AS refused FROM feat"
SQL["k_incremental_refresh"] = SQL["k_features_buckets"]
SQL["p_landing_mixed"] = with_(PRICES) + """
SELECT ticker, date, open, high, low, close, CASE WHEN day(date) % 2 = 0 THEN adj_close + 1 ELSE close END AS adj_close,
       volume, ingestion_timestamp FROM prices"""

SQL["p_local_dates"] = SQL["p_rename"]
SQL["p_landing_quarantine"] = with_(PRICES) + f"SELECT {PRICES_COLS}, 4 AS bad_files FROM prices WHERE day(date) % 5 < 2"
SQL["p_landing_quarantine_csv"] = with_(PRICES) + f"SELECT {PRICES_COLS}, 2 AS bad_files FROM prices WHERE day(date) % 5 < 2"

FIXED = PRICES.replace("prices AS (", "prices_given AS (", 1) + """, prices AS (
  SELECT * REPLACE (CASE WHEN day(date) = 15 AND month(date) = 3 AND year(date) <> 1997 THEN close + 5 ELSE close END AS close) FROM prices_given)"""
SQL["k_state_refresh"] = with_(FIXED, PRICES_CLEAN, FEAT_C) + f"""
SELECT {FEATURE_SELECT}, (SELECT count(DISTINCT a.ticker) FROM prices a WHERE date >= DATE '1998-06-01' AND NOT EXISTS (
  SELECT 1 FROM prices b WHERE b.ticker = a.ticker AND b.date < DATE '1998-06-01')) AS late_in_order FROM feat"""
SQL["k_compact"] = with_(PRICES) + f"SELECT {PRICES_COLS}, true AS fewer_files, 1 AS files_a_year FROM prices"

# --- full recompute checks ---


def verify_summary(src: str) -> str:
    wrong = lambda a, b: (f"NOT CASE WHEN {a} IS NULL OR {b} IS NULL THEN {a} IS NULL AND {b} IS NULL "  # noqa: E731
                          f"ELSE abs({a} - {b}) <= 1e-9 * greatest(abs({b}), 1.0) END")
    parts = [f"""count(*) FILTER (rn >= {n}) AS {k}_compared,
  count(*) FILTER (rn >= {n} AND {wrong(a, b)}) AS {k}_mismatches""" for k, a, b, n in (
        ("return", "daily_return", "r", 2), ("ma7", "moving_avg_7", "m7", 7), ("ma30", "moving_avg_30", "m30", 30))]
    return f"""
SELECT *, return_mismatches + ma7_mismatches + ma30_mismatches = 0 AS passed FROM (
  SELECT ticker, {", ".join(parts)} FROM (
    SELECT *, row_number() OVER ({W}) AS rn,
      (close - lag(close) OVER ({W})) / nullif(lag(close) OVER ({W}), 0) AS r,
      avg(close) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
      avg(close) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS m30
    FROM {src}) GROUP BY ticker)"""


SQL["f_verify_summary"] = FT + verify_summary("feat")
SQL["f_verify_injected"] = FT + verify_summary("""(
  SELECT * REPLACE (
    CASE WHEN day(date) = 15 THEN daily_return + 0.5 ELSE daily_return END AS daily_return,
    CASE WHEN day(date) = 20 THEN NULL ELSE moving_avg_7 END AS moving_avg_7,
    CASE WHEN day(date) = 20 THEN moving_avg_30 * 1.01 ELSE moving_avg_30 END AS moving_avg_30) FROM feat)""")

# --- models: what does not depend on the fitted trees ---

TEST_ROWS = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ, LABELED, SPLIT_BOUNDS) + f""",
test AS (SELECT * FROM labeled WHERE {COMPLETE} AND date > (SELECT split_date FROM bounds))
"""
for _key in ("m_rf_predictions", "m_gbt_predictions"):
    SQL[_key] = TEST_ROWS + """SELECT ticker, date, next_day_up, true AS prediction_ok, true AS probability_ok,
  true AS agrees FROM test"""
SIDES = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ, LABELED, SPLIT_BOUNDS) + f""",
sides AS (SELECT CASE WHEN date <= (SELECT split_date FROM bounds) THEN 'train' ELSE 'test' END AS split, count(*) AS rows,
  count(*) FILTER (next_day_up = 1) AS positives FROM labeled WHERE {COMPLETE} GROUP BY 1)
"""
SQL["m_metrics"] = SIDES + """SELECT split, metric, rows, true AS in_range
FROM sides, (VALUES ('auc'), ('accuracy'), ('f1')) m(metric)"""
SQL["m_quality_bands"] = SIDES + """SELECT true AS auc_band_ok, true AS gap_band_ok, true AS auc_ok, rows, positives
FROM sides WHERE split = 'test'"""
SQL["m_cv_best"] = SIDES + """SELECT CAST(27 AS BIGINT) AS grid_points, CAST(3 AS BIGINT) AS folds, true AS best_in_grid, rows AS train_rows
FROM sides WHERE split = 'train'"""
SQL["m_tree_table"] = SIDES + """SELECT rows, CAST(0 AS BIGINT) AS prediction_mismatches, CAST(0 AS BIGINT) AS probability_mismatches, model_type
FROM sides, (VALUES ('rf'), ('gbt')) k(model_type) WHERE split = 'test'"""
SQL["m_model_roundtrip"] = TEST_ROWS + "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mismatches FROM test"
SQL["m_score_batch"] = with_(PRICES, PRICES_CLEAN, FEAT_C, REQUESTS) + f"""
SELECT r.request_id, r.ticker,
       CASE WHEN f.date IS NOT NULL THEN 'ok'
            WHEN r.ticker IN (SELECT ticker FROM feat) THEN 'no_data_yet' ELSE 'no_ticker' END AS status,
       f.date AS feature_date, f.date IS NOT NULL AND {COMPLETE} AS has_prediction, true AS confidence_ok
FROM requests r ASOF LEFT JOIN feat f ON r.ticker = f.ticker AND r.as_of_date >= f.date"""
RULE = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ, LABELED, SPLIT_BOUNDS) + """,
s AS (SELECT CASE WHEN date <= (SELECT split_date FROM bounds) THEN 'train' ELSE 'test' END AS split, daily_return AS x,
        next_day_up AS y, CASE WHEN daily_return > 0 THEN 1 ELSE 0 END AS p FROM labeled),
ranked AS (  -- mid-ranks of equal scores
  SELECT split, y, p, avg(rk) OVER (PARTITION BY split, x) AS mid FROM (
    SELECT *, row_number() OVER (PARTITION BY split ORDER BY x) AS rk FROM s)),
auc AS (SELECT split, (sum(mid) FILTER (y = 1) - (sum(y) * (sum(y) + 1)) / 2.0) / (sum(y) * (count(*) - sum(y))) AS auc
        FROM ranked GROUP BY split),
cls AS (SELECT split, c, count(*) FILTER (y = c) AS actual, count(*) FILTER (p = c) AS predicted,
          count(*) FILTER (y = c AND p = c) AS tp FROM s, (VALUES (0), (1)) k(c) GROUP BY split, c),
m AS (SELECT split, sum(tp) / CAST(sum(actual) AS DOUBLE) AS accuracy,
        sum(CASE WHEN tp > 0 THEN 2.0 * tp / (actual + predicted) ELSE 0 END * actual) / sum(actual) AS f1
      FROM cls GROUP BY split),
metrics AS (
  SELECT split, 'auc' AS metric, CAST(auc AS DOUBLE) AS value FROM auc
  UNION ALL SELECT split, 'accuracy', CAST(accuracy AS DOUBLE) FROM m UNION ALL SELECT split, 'f1', CAST(f1 AS DOUBLE) FROM m)
"""
SQL["m_metrics_rule"] = RULE + f"SELECT split, metric, {rounded(['value'])} FROM metrics"
SQL["m_bands_rule"] = RULE + f""",
b AS (SELECT max(value) FILTER (split = 'test') AS test_auc,
        abs(max(value) FILTER (split = 'train') - max(value) FILTER (split = 'test')) AS auc_gap FROM metrics WHERE metric = 'auc')
SELECT {rounded(['test_auc', 'auc_gap'])},
  CASE WHEN test_auc >= 0.8 THEN 'excellent' WHEN test_auc >= 0.7 THEN 'good' WHEN test_auc >= 0.6 THEN 'moderate' ELSE 'poor' END AS auc_band,
  CASE WHEN auc_gap <= 0.05 THEN 'low' WHEN auc_gap <= 0.1 THEN 'moderate' ELSE 'high' END AS gap_band
FROM b"""

LABELED_ROWS = with_(PRICES, PRICES_CLEAN, FEAT_C, TRAIN_READ, LABELED)


def auc_by(key: str, src: str) -> str:
    """Rank sums with mid-ranks of equal scores."""
    return f"""{key}_ranked AS (
  SELECT {key}, next_day_up AS y, avg(rk) OVER (PARTITION BY {key}, daily_return) AS mid FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY daily_return) AS rk FROM {src})),
{key}_auc AS (
  SELECT {key}, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives, CASE WHEN sum(y) > 0 AND sum(y) < count(*) THEN
    (sum(mid) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) END AS auc
  FROM {key}_ranked GROUP BY {key})"""


SQL["m_auc_by_ticker"] = LABELED_ROWS + f", {auc_by('ticker', 'labeled')} SELECT ticker, rows, positives, ROUND_TEXT(auc, 6) AS auc FROM ticker_auc"
SQL["m_auc_by_fold"] = LABELED_ROWS + f""",
span AS (SELECT min(date) AS lo, max(date) - min(date) + 1 AS n FROM labeled),
folded AS (SELECT labeled.*, CAST(least(floor((date - lo) * 3 / CAST(n AS DOUBLE)), 2) AS INTEGER) AS fold FROM labeled, span),
{auc_by('fold', 'folded')} SELECT fold, rows, positives, ROUND_TEXT(auc, 6) AS auc FROM fold_auc"""
SQL["m_walk_forward"] = LABELED_ROWS + f""",
span AS (SELECT min(date) AS lo, max(date) - min(date) + 1 AS n FROM labeled),
folds AS (
  SELECT CAST(f AS INTEGER) AS fold, lo + CAST(floor(n * (f + 1) / 5.0) AS INTEGER) AS valid_start,
         lo + CAST(floor(n * (f + 2) / 5.0) AS INTEGER) - 1 AS valid_end FROM span, range(4) t(f)),
trained AS (
  SELECT fold, count(*) AS train_rows, ROUND_TEXT(avg(daily_return), 9) AS mean
  FROM folds JOIN labeled ON date <= valid_start - 31 GROUP BY fold),
judged AS (SELECT folds.fold, labeled.* FROM folds JOIN labeled ON date BETWEEN valid_start AND valid_end),
{auc_by('fold', 'judged')},
right_ones AS (SELECT fold, avg(CASE WHEN (daily_return > mean) = (next_day_up = 1) THEN 1.0 ELSE 0.0 END) AS accuracy
  FROM judged JOIN trained USING (fold) GROUP BY fold)
SELECT fold, valid_start - 31 AS train_end, valid_start, valid_end, train_rows, rows AS valid_rows, ROUND_TEXT(accuracy, 6) AS accuracy,
  ROUND_TEXT(auc, 6) AS auc FROM folds JOIN trained USING (fold) JOIN fold_auc USING (fold) JOIN right_ones USING (fold)"""

SQL["k_daily_run"] = REPORT_CTES + """
SELECT report.*, coalesce(b.n, 0) AS rows_before, coalesce(a.n, 0) AS rows_after, row_count AS feature_rows,
  CASE WHEN row_count > 0 THEN 'processed' ELSE 'failed' END AS status,
  CASE WHEN row_count > 0 THEN NULL WHEN b.n IS NULL THEN 'no_data' WHEN a.n IS NULL THEN 'no_valid_rows' ELSE 'no_features' END AS reason,
  CAST(0 AS BIGINT) AS late_in_order
FROM report LEFT JOIN (SELECT ticker, count(*) AS n FROM prices GROUP BY ticker) b USING (ticker)
LEFT JOIN (SELECT ticker, count(*) AS n FROM prices_clean GROUP BY ticker) a USING (ticker)"""
SQL["k_profile_increment"] = SQL["f_validation_report"]
SQL["k_profile_ranges"] = SQL["f_feature_ranges"]
SQL["f_summary_all"] = with_(PRICES, PRICES_CLEAN, FEAT_C) + "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, count({c}) AS count, ROUND_TEXT(avg({c}), 6) AS mean, ROUND_TEXT(stddev_samp({c}), 6) AS stddev, ROUND_TEXT(min({c}), 6) AS min,
  ROUND_TEXT(quantile_cont({c}, 0.25), 6) AS p25, ROUND_TEXT(quantile_cont({c}, 0.5), 6) AS p50, ROUND_TEXT(quantile_cont({c}, 0.75), 6) AS p75,
  ROUND_TEXT(max({c}), 6) AS max FROM feat""" for c in FEATURE_DOUBLES)

SQL["k_catalog_read"] = SQL["f_typed_projection"]
SQL["k_guarded"] = f"""SELECT *, 'stored' AS source FROM ({SQL['f_validation_report']})
UNION ALL SELECT ticker, false, 0, 0, false, false, false, 0, '', false, 'absent' FROM ({SQL['f_validation_report']})"""
SQL["k_counted"] = with_(PRICES, PRICES_DIRTY) + """
SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS written, count(*) AS stored FROM prices_dirty WHERE year(date) IN (1996, 1997) GROUP BY 1"""
SQL["p_session_view"] = with_(PRICES) + "SELECT ticker, max(close) AS top, count(*) AS days FROM prices WHERE volume > 10 GROUP BY ticker"

SQL["f_features_blocked"] = SQL["f_features_c2c"]
SQL["f_asof_blocked"] = SQL["f_asof_join"]
SQL["f_ticks_blocked"] = f"""
WITH ticks AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE 'S' || cast(l_suppkey AS varchar) END AS ticker,
         l_orderkey * 8 + l_linenumber AS trade, l_extendedprice AS px FROM lineitem)
SELECT ticker, trade, px, ROUND_TEXT(avg(px) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS moving_avg_30,
       max(px) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS top_7,
       ROUND_TEXT(px - lag(px, 10) OVER w, 6) AS change_10
FROM ticks WINDOW w AS (PARTITION BY ticker ORDER BY trade, px)"""

SQL = {k: expanded(v) for k, v in SQL.items()}
