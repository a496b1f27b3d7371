"""DuckDB SQL for each registered query (the correctness oracle).

Views ``lineitem``, ``events``, ``documents`` ... are registered by the
caller.  Every double the Spark side rounds for comparison is rounded to the
same digits here; sums of bigints are cast back to BIGINT (DuckDB widens).
"""

from __future__ import annotations

from candlestack.sources.tables import TABLES

# Daily bars from ticks: Open/Close = first/last tick by (ts, tiebreak).
_TICK_KEY = "row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"

BARS_CTE = f"""
bars AS (
  SELECT l_returnflag AS symbol,
         CAST(l_shipdate AS DATE) AS "Date",
         arg_min(l_extendedprice, {_TICK_KEY}) AS "Open",
         max(l_extendedprice) AS "High",
         min(l_extendedprice) AS "Low",
         arg_max(l_extendedprice, {_TICK_KEY}) AS "Close",
         arg_max(l_extendedprice, {_TICK_KEY}) AS "Adj Close",
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS "Volume"
  FROM lineitem
  GROUP BY 1, 2
)"""

def _avg_exact(x: str, d: int) -> str:
    """Exact mean rounded half-up to ``d`` digits, as Spark's decimal average
    (``functions.numeric.avg_rounded``): the sum is taken in DECIMAL(38,10),
    then integer arithmetic rounds sum / count."""
    a = f"CAST(replace(CAST(sum(CAST({x} AS DECIMAL(38,10))) AS VARCHAR), '.', '') AS HUGEINT)"
    u = f"(CAST(count({x}) AS HUGEINT) * {10 ** (10 - d)})"
    return f"(CAST(sign({a}) * ((2 * abs({a}) + {u}) // (2 * {u})) AS DOUBLE) / {10 ** d})"


_STATS = f"""
  {_avg_exact('"Close"', 4)} AS "Avg_Close",
  CAST(sum("Volume") AS BIGINT) AS "Total_Volume",
  {_avg_exact('"High"', 4)} AS "Avg_High",
  {_avg_exact('"Low"', 4)} AS "Avg_Low",
  {_avg_exact('"Open"', 4)} AS "Avg_Open",
  round(stddev_samp("Close"), 4) AS "Std_Close",
  count(*) AS "Trading_Days"
"""

_LABELS = """
labelled AS (
  SELECT *, CAST(year("Date") AS INTEGER) AS "Year",
         CAST(year("Date") AS VARCHAR) || '-Q' || CAST(quarter("Date") AS VARCHAR) AS "Quarter",
         strftime("Date", '%Y-%m') AS "Month"
  FROM bars
)"""

# Stats per level in long form: raw close mean ``ac`` (for growth), exact
# rounded means ``rc rh rl ro`` at 4 digits and ``rc6 rh6 rl6 ro6`` at 6.
_LONG_RAW = f"""
long_raw AS (
  SELECT symbol,
         CASE WHEN "Month" IS NOT NULL THEN 'monthly'
              WHEN "Quarter" IS NOT NULL THEN 'quarterly' ELSE 'yearly' END AS period_type,
         coalesce("Month", "Quarter", CAST("Year" AS VARCHAR)) AS period,
         avg("Close") AS ac, CAST(sum("Volume") AS BIGINT) AS tv,
         {_avg_exact('"Close"', 4)} AS rc, {_avg_exact('"High"', 4)} AS rh,
         {_avg_exact('"Low"', 4)} AS rl, {_avg_exact('"Open"', 4)} AS ro,
         {_avg_exact('"Close"', 6)} AS rc6, {_avg_exact('"High"', 6)} AS rh6,
         {_avg_exact('"Low"', 6)} AS rl6, {_avg_exact('"Open"', 6)} AS ro6,
         stddev_samp("Close") AS sc, count(*) AS td
  FROM labelled
  GROUP BY GROUPING SETS ((symbol, "Year"), (symbol, "Quarter"), (symbol, "Month"))
)"""

_PERIOD_START = """
  CASE period_type
    WHEN 'monthly' THEN CAST(strptime(period || '-01', '%Y-%m-%d') AS DATE)
    WHEN 'quarterly' THEN make_date(CAST(substr(period, 1, 4) AS INTEGER),
                                    CAST(split_part(period, '-Q', 2) AS INTEGER) * 3 - 2, 1)
    ELSE make_date(CAST(substr(period, 1, 4) AS INTEGER), 1, 1) END"""

_YOY = """CASE WHEN period_type = 'yearly' THEN (round(
      (ac - lag(ac) OVER (PARTITION BY symbol, period_type ORDER BY period))
      / lag(ac) OVER (PARTITION BY symbol, period_type ORDER BY period) * 100, 4)
      + CAST(0 AS DOUBLE)) END"""


def _avg_round2(x: str) -> str:
    """Exact mean rounded half-up to 2 digits."""
    return _avg_exact(x, 2)


# Rounded signed values below add +0.0: DuckDB's round keeps the sign of a
# tiny negative (-0.0) where Spark's half-up rounding gives +0.0.


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["bars_daily"] = _with(BARS_CTE) + """
SELECT symbol, "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume" FROM bars"""

ORACLE["monthly_stats"] = _with(BARS_CTE) + f"""
SELECT symbol, strftime("Date", '%Y-%m') AS "Month", {_STATS}
FROM bars GROUP BY 1, 2"""

ORACLE["quarterly_stats"] = _with(BARS_CTE) + f"""
SELECT symbol,
       CAST(year("Date") AS VARCHAR) || '-Q' || CAST(quarter("Date") AS VARCHAR) AS "Quarter",
       {_STATS}
FROM bars GROUP BY 1, 2"""

ORACLE["yearly_stats"] = _with(BARS_CTE) + f"""
SELECT *, round(("Avg_Close_raw" - lag("Avg_Close_raw") OVER w)
                / lag("Avg_Close_raw") OVER w * 100, 4) + CAST(0 AS DOUBLE) AS "YoY_Growth"
FROM (SELECT symbol, CAST(year("Date") AS INTEGER) AS "Year", {_STATS},
             avg("Close") AS "Avg_Close_raw"
      FROM bars GROUP BY 1, 2) y
WINDOW w AS (PARTITION BY symbol ORDER BY "Year")"""
# "Avg_Close_raw" is dropped below (DuckDB: SELECT * EXCLUDE).
ORACLE["yearly_stats"] = ("SELECT * EXCLUDE (\"Avg_Close_raw\") FROM (\n"
                          + ORACLE["yearly_stats"] + "\n) t")

ORACLE["yoy_growth"] = ORACLE["yearly_stats"]

ORACLE["period_stats_long"] = _with(BARS_CTE, _LABELS, _LONG_RAW) + f"""
SELECT symbol, period_type, period,
       rc AS "Avg_Close", tv AS "Total_Volume", rh AS "Avg_High",
       rl AS "Avg_Low", ro AS "Avg_Open", round(sc, 4) AS "Std_Close",
       td AS "Trading_Days", {_YOY} AS "YoY_Growth",
       {_PERIOD_START} AS period_start
FROM long_raw"""

ORACLE["period_start"] = _with(BARS_CTE, _LABELS, _LONG_RAW) + f"""
SELECT symbol, period_type, period, {_PERIOD_START} AS period_start FROM long_raw"""

ORACLE["monthly_analysis"] = _with(BARS_CTE) + f"""
SELECT symbol, strftime("Date", '%Y-%m') AS "Month",
       {_avg_round2('"Close"')} AS "Avg_Close",
       CAST(sum("Volume") AS BIGINT) AS "Total_Volume"
FROM bars GROUP BY 1, 2"""


def _bar_cols(prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{c}"' for c in
                     ["symbol", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"])


_RET = """
ret AS (
  SELECT *, ("Close" - lag("Close") OVER w) / lag("Close") OVER w AS dr
  FROM {src} WINDOW w AS (PARTITION BY symbol ORDER BY "Date")
)"""

_ROLL_WINDOWS = """
WINDOW w5 AS (PARTITION BY symbol ORDER BY "Date" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
       w20 AS (PARTITION BY symbol ORDER BY "Date" ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""

_MA5 = 'CASE WHEN count("Close") OVER w5 = 5 THEN round(avg("Close") OVER w5, 4) END AS "MA5"'
_MA20 = 'CASE WHEN count("Close") OVER w20 = 20 THEN round(avg("Close") OVER w20, 4) END AS "MA20"'
_VOL = ('CASE WHEN count(dr) OVER w20 = 20 THEN '
        'round(stddev_samp(dr) OVER w20 * sqrt(252.0), 4) END AS "Volatility"')

ORACLE["daily_return"] = _with(BARS_CTE, _RET.format(src="bars")) + f"""
SELECT {_bar_cols()}, (round(dr, 4) + CAST(0 AS DOUBLE)) AS "Daily Return" FROM ret"""

ORACLE["moving_avg_5"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()}, {_MA5} FROM bars {_ROLL_WINDOWS}"""

ORACLE["moving_avg_20"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()}, {_MA20} FROM bars {_ROLL_WINDOWS}"""

ORACLE["volatility_20"] = _with(BARS_CTE, _RET.format(src="bars")) + f"""
SELECT {_bar_cols()}, (round(dr, 4) + CAST(0 AS DOUBLE)) AS "Daily Return", {_VOL} FROM ret {_ROLL_WINDOWS}"""

_LAST30 = """
last30 AS (
  SELECT * FROM bars
  WHERE "Date" BETWEEN (SELECT max("Date") FROM bars) - INTERVAL 30 DAY
                   AND (SELECT max("Date") FROM bars)
)"""

_ANALYZE = (_with(BARS_CTE, _LAST30, _RET.format(src="last30")) + f"""
SELECT {_bar_cols()}, (round(dr, 4) + CAST(0 AS DOUBLE)) AS "Daily Return", {_MA5}, {_MA20}, {_VOL}
FROM ret {_ROLL_WINDOWS}""")

ORACLE["analyze_last_n_days"] = _ANALYZE

ORACLE["headline_stats"] = _with(BARS_CTE, _LAST30, _RET.format(src="last30")) + f"""
, rolled AS (
  SELECT symbol, "Close", dr,
         CASE WHEN count(dr) OVER w20 = 20 THEN stddev_samp(dr) OVER w20 * sqrt(252.0) END AS vol
  FROM ret {_ROLL_WINDOWS}
)
SELECT symbol, (round(avg(dr), 4) + CAST(0 AS DOUBLE)) AS "Average_Daily_Return", round(avg(vol), 4) AS "Volatility",
       round(max("Close"), 4) AS "Max_Close", round(min("Close"), 4) AS "Min_Close"
FROM rolled GROUP BY symbol"""

ORACLE["price_movement"] = _with(BARS_CTE) + f"""
, moves AS (SELECT symbol, (round(("Close" - "Open") / "Open" * 100, 2) + CAST(0 AS DOUBLE)) AS mv FROM bars)
SELECT symbol, {_avg_round2('mv')} AS "Avg_Daily_Return_%",
       round(min(mv), 2) AS "Max_Daily_Loss_%", round(max(mv), 2) AS "Max_Daily_Gain_%"
FROM moves GROUP BY symbol"""


def _describe_sql(names, quart_fn, src: str = "bars", ctes: tuple = ()) -> str:
    cols = ["Open", "High", "Low", "Close", "Volume"]
    parts = []
    for c in cols:
        x = f'CAST("{c}" AS DOUBLE)'
        parts.append(
            f"""SELECT symbol, '{c}' AS col, CAST(count({x}) AS DOUBLE) AS "count",
                {_avg_exact(x, 4)} AS "mean", round(stddev_samp({x}), 4) AS "{names[2]}",
                round(min({x}), 4) AS "min", round({quart_fn(x, 0.25)}, 4) AS "25%",
                round({quart_fn(x, 0.5)}, 4) AS "50%", round({quart_fn(x, 0.75)}, 4) AS "75%",
                round(max({x}), 4) AS "max" FROM {src} GROUP BY symbol""")
    stats = ["count", "mean", names[2], "min", "25%", "50%", "75%", "max"]
    body = "\nUNION ALL\n".join(parts)
    pivots = ",\n".join(
        f"""max(CASE WHEN col = '{c}' THEN v END) AS "{c}\"""" for c in cols)
    unpivot = "\nUNION ALL\n".join(
        f"""SELECT symbol, col, '{s}' AS statistic, "{s}" AS v FROM per_col""" for s in stats)
    return _with(BARS_CTE, *ctes) + f""", per_col AS ({body}),
long AS ({unpivot})
SELECT symbol, statistic, {pivots} FROM long GROUP BY symbol, statistic"""


ORACLE["describe_exact"] = _describe_sql(
    ["count", "mean", "std"], lambda x, p: f"quantile_cont({x}, {p})")

ORACLE["row_count"] = _with(BARS_CTE) + "SELECT count(*) AS row_count FROM bars"

ORACLE["date_range"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()} FROM bars WHERE "Date" BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"""

ORACLE["top_k_latest"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()} FROM bars ORDER BY "Date" DESC, symbol ASC LIMIT 100"""

ORACLE["page"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()} FROM bars ORDER BY symbol, "Date" LIMIT 5 OFFSET 10"""

ORACLE["page_deep"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()} FROM bars ORDER BY symbol, "Date" LIMIT 5 OFFSET 5000"""

ORACLE["page_stats"] = _with(BARS_CTE) + f"""
, pos AS (SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY "Date") - 1) // 5 AS page
          FROM bars)
SELECT symbol, CAST(page AS BIGINT) AS page, min("Date") AS "Start_Date",
       max("Date") AS "End_Date", {_avg_round2('"Close"')} AS "Avg_Close",
       CAST(sum("Volume") AS BIGINT) AS "Total_Volume", count(*) AS "Rows"
FROM pos GROUP BY symbol, page"""

# The tokenizer's delimiters (space, tab, newline, CR, form feed).
ORACLE["word_count"] = r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word"""

ORACLE["log_ingest"] = """
SELECT event_id, ts, user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events"""

ORACLE["metric_window"] = """
SELECT time_bucket(INTERVAL 10 SECOND, ts) AS window_start,
       time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND AS window_end,
       event_type, count(*) AS n, round(avg(value), 4) AS avg_value,
       round(min(value), 4) AS min_value, round(max(value), 4) AS max_value,
       round(last(value ORDER BY ts, event_id), 4) AS last_value
FROM events GROUP BY 1, 2, 3"""

ORACLE["uptime_gaps"] = """
SELECT monitor, gap_start, gap_end, round(gap_seconds, 4) AS gap_seconds FROM (
  SELECT event_type AS monitor, lag(ts) OVER w AS gap_start, ts AS gap_end,
         date_diff('microsecond', lag(ts) OVER w, ts) / 1000000.0 AS gap_seconds
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
  UNION ALL
  SELECT event_type, max(ts), (SELECT max(ts) FROM events),
         date_diff('microsecond', max(ts), (SELECT max(ts) FROM events)) / 1000000.0
  FROM events GROUP BY event_type
) WHERE gap_seconds > 3600.0"""

ORACLE["uptime_availability"] = """
WITH seen AS (SELECT event_type AS monitor, date_trunc('hour', ts) AS bucket_start,
             count(DISTINCT floor(date_diff('microsecond', date_trunc('hour', ts), ts) / 5000000))
               AS seen_slots
      FROM events GROUP BY 1, 2),
hours AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                                        INTERVAL 1 HOUR)) AS bucket_start FROM events)
SELECT m.monitor, h.bucket_start, coalesce(s.seen_slots, 0) AS seen_slots,
       CAST(720 AS BIGINT) AS expected_slots,
       round(coalesce(s.seen_slots, 0) / 720.0, 4) AS availability
FROM (SELECT DISTINCT event_type AS monitor FROM events) m CROSS JOIN hours h
LEFT JOIN seen s ON s.monitor = m.monitor AND s.bucket_start = h.bucket_start"""

ORACLE["summary_stats"] = _describe_sql(
    ["count", "mean", "stddev"], lambda x, p: f"quantile_disc({x}, {p})")


# --- shaping ---------------------------------------------------------------------

_ADJ = ", ".join(f'"{c}" / 20.0 AS "{c}"' for c in ["Open", "High", "Low", "Close", "Adj Close"])

ORACLE["split_adjust"] = _with(BARS_CTE) + f"""
SELECT symbol, "Date", {_ADJ}, "Volume" FROM bars"""

ORACLE["derived_columns"] = _with(BARS_CTE) + f"""
, adj AS (SELECT symbol, "Date", {_ADJ}, "Volume" FROM bars)
SELECT *, ("Close" - "Open") / "Open" AS "Return",
       ("Open" + "Close") / 2 AS "AVG Price",
       ("Close" - "Open") / "Open" * 100 AS "Close Pct Change"
FROM adj"""

ORACLE["normalise_bars"] = _with(BARS_CTE) + """
SELECT symbol, strftime("Date", '%Y-%m-%d') AS "Date", "Open", "High", "Low", "Close",
       "Volume", "Close" AS "Adj Close"
FROM bars"""

ORACLE["coerce_defaults"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()}, CAST(0 AS DOUBLE) AS "Return", CAST(0 AS DOUBLE) AS "AVG Price",
       CAST(0 AS DOUBLE) AS "Close Pct Change"
FROM bars"""

ORACLE["null_normalise"] = ORACLE["yearly_stats"]


# --- sinks -----------------------------------------------------------------------


def _num6(x: str) -> str:
    return (f"regexp_replace(regexp_replace(CAST(CAST(round({x}, 6) AS DECIMAL(38,6)) AS VARCHAR),"
            f" '0+$', ''), '\\.$', '')")


def _field(name: str, x: str) -> str:
    return f"'{name}=' || {_num6(x)}"


_DERIVED = """
derived AS (
  SELECT *, ("Close" - "Open") / "Open" AS ret, ("Open" + "Close") / 2 AS avgp,
         ("Close" - "Open") / "Open" * 100 AS pct
  FROM bars
)"""

# Field names of the bar points, in their order.
_BAR_FIELDS = [("open", '"Open"'), ("high", '"High"'), ("low", '"Low"'), ("close", '"Close"'),
               ("adj_close", '"Adj Close"'), ("volume", '"Volume"'), ("return", "ret"),
               ("avg_price", "avgp"), ("close_pct_change", "pct")]

ORACLE["to_points"] = _with(BARS_CTE, _DERIVED) + f"""
SELECT symbol, "Date",
       CAST(("Date" - DATE '1970-01-01') AS BIGINT) * 86400000000000 AS time_ns,
       'stock_prices,symbol=' || symbol || ' '
         || concat_ws(',', {", ".join(_field(n, x) for n, x in _BAR_FIELDS)})
         || ' ' || CAST(CAST(("Date" - DATE '1970-01-01') AS BIGINT) * 86400000000000 AS VARCHAR)
         AS line
FROM derived"""

_STAT_FIELDS = [("avg_close", "rc6"), ("total_volume", "tv"), ("avg_high", "rh6"),
                ("avg_low", "rl6"), ("avg_open", "ro6"), ("std_close", "sc")]

ORACLE["to_points_stats"] = _with(BARS_CTE, _LABELS, _LONG_RAW) + f"""
, withyoy AS (
  SELECT *, CASE WHEN period_type = 'yearly' THEN
              (ac - lag(ac) OVER (PARTITION BY symbol, period_type ORDER BY period))
              / lag(ac) OVER (PARTITION BY symbol, period_type ORDER BY period) * 100 END AS yoy,
         CAST(({_PERIOD_START} - DATE '1970-01-01') AS BIGINT) * 86400000000000 AS time_ns
  FROM long_raw
)
SELECT symbol, period_type, period, time_ns,
       concat_ws(',', 'stock_aggregated_stats', 'symbol=' || symbol, 'period_type=' || period_type,
                 CASE WHEN period_type = 'monthly' THEN 'month=' || period END,
                 CASE WHEN period_type = 'quarterly' THEN 'quarter=' || period END,
                 CASE WHEN period_type = 'yearly' THEN 'year=' || period END)
       || ' ' || concat_ws(',', {", ".join(_field(n, x) for n, x in _STAT_FIELDS)},
                           'trading_days=' || CAST(td AS VARCHAR) || 'i',
                           'yoy_growth=' || {_num6('yoy')})
       || ' ' || CAST(time_ns AS VARCHAR) AS line
FROM withyoy"""

_STATS_ROUNDED = f"""
stats AS (
  SELECT symbol, period_type, period, {_PERIOD_START} AS period_start,
         rc AS "Avg_Close", tv AS "Total_Volume", rh AS "Avg_High",
         rl AS "Avg_Low", ro AS "Avg_Open", round(sc, 4) AS "Std_Close",
         td AS "Trading_Days", {_YOY} AS "YoY_Growth"
  FROM long_raw
)"""

ORACLE["to_documents"] = _with(BARS_CTE, _LABELS, _LONG_RAW, _STATS_ROUNDED) + """
SELECT symbol || '|' || period_type || '|' || period AS _id,
       'stock_' || period_type AS _index,
       CAST(json_object('symbol', symbol, 'period_type', period_type, 'period', period,
                        'period_start', period_start, 'Avg_Close', "Avg_Close",
                        'Total_Volume', "Total_Volume", 'Avg_High', "Avg_High",
                        'Avg_Low', "Avg_Low", 'Avg_Open', "Avg_Open", 'Std_Close', "Std_Close",
                        'Trading_Days', "Trading_Days", 'YoY_Growth', "YoY_Growth") AS VARCHAR)
         AS _source
FROM stats"""

_BARS_OF = BARS_CTE.replace("FROM lineitem", "FROM lineitem WHERE l_linestatus = '{s}'")

ORACLE["upsert_bars"] = ("WITH " + _BARS_OF.replace("bars AS", "base AS").format(s="F") + ",\n"
                         + _BARS_OF.replace("bars AS", "delta AS").format(s="O") + f"""
SELECT {_bar_cols('b.')} FROM base b ANTI JOIN delta d ON b.symbol = d.symbol AND b."Date" = d."Date"
UNION ALL
SELECT {_bar_cols()} FROM delta""")

ORACLE["land_bars"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()}, CAST(year("Date") AS INTEGER) AS year FROM bars"""

ORACLE["sink_report"] = _with(BARS_CTE, _LABELS, _LONG_RAW) + """
SELECT 'stock_' || period_type AS target, count(*) AS written, CAST(0 AS BIGINT) AS failed
FROM long_raw GROUP BY 1"""

ORACLE["scan_csv"] = ORACLE["bars_daily"]

ORACLE["union_by_name_missing"] = _with(BARS_CTE) + """
SELECT symbol, "Date", "Open", "High", "Low", "Close",
       CASE WHEN symbol = 'R' THEN "Adj Close" END AS "Adj Close", "Volume"
FROM bars"""

ORACLE["scan_csv_corrupt"] = """
SELECT count(*) AS good_rows, (SELECT count(*) FROM nation) AS bad_rows FROM events"""

ORACLE["corrupt_lines"] = """
SELECT 'bad-' || n_nationkey || ',' || n_name || ',' || n_name || ',' || n_name || ','
       || n_name || ',' || n_name AS line FROM nation"""

ORACLE["bars_csv_extra_columns"] = ORACLE["bars_daily"]
ORACLE["bars_csv_no_adj_close"] = _with(BARS_CTE) + """
SELECT symbol, "Date", "Open", "High", "Low", "Close", "Close" AS "Adj Close", "Volume"
FROM bars"""

# the corrected delta: version 2 has the volume as it is, version 1 doubled
ORACLE["upsert_bars_corrections"] = ORACLE["upsert_bars"]

ORACLE["log_ingest_stream"] = ORACLE["log_ingest"]
ORACLE["metric_window_stream"] = ORACLE["metric_window"]
ORACLE["incremental_bars"] = ORACLE["bars_daily"]

ORACLE["bars_csv"] = ORACLE["bars_daily"]
ORACLE["scan_csv_lenient"] = ORACLE["bars_daily"]
ORACLE["log_ingest_json_stream"] = ORACLE["log_ingest"]

ORACLE["describe_last_n_days"] = _describe_sql(
    ["count", "mean", "std"], lambda x, p: f"quantile_cont({x}, {p})", "last30", (_LAST30,))

ORACLE["total_pages"] = _with(BARS_CTE) + """
SELECT CAST(ceil(count(*) / 5.0) AS BIGINT) AS total_pages FROM bars"""

ORACLE["retention_sweep"] = """
SELECT *, event_type || '-' || strftime(ts, '%Y.%m.%d') AS set_name FROM events
WHERE NOT (event_type = 'error'
           AND CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events) - INTERVAL 2 DAY)"""

ORACLE["retention"] = ORACLE["retention_sweep"]

ORACLE["date_range_landed"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()}, CAST(year("Date") AS INTEGER) AS year FROM bars
WHERE "Date" BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"""

ORACLE["file_rows"] = "\nUNION ALL\n".join(
    f"SELECT '{t}.parquet' AS file_name, count(*) AS rows FROM {t}" for t in TABLES)

ORACLE["bars_daily_struct_order"] = ORACLE["bars_daily"]
ORACLE["metric_window_stream_daily_files"] = ORACLE["metric_window"]

ORACLE["top_k_latest_documents"] = _with(BARS_CTE) + f"""
SELECT {_bar_cols()}, ("Close" - "Open") / "Open" AS "Return",
       ("Open" + "Close") / 2 AS "AVG Price", ("Close" - "Open") / "Open" * 100 AS "Close Pct Change"
FROM bars ORDER BY "Date" DESC, symbol ASC LIMIT 100"""

ORACLE["scan_documents"] = ORACLE["top_k_latest_documents"].replace(
    ' ORDER BY "Date" DESC, symbol ASC LIMIT 100', "")
ORACLE["period_stats_from_landed"] = ORACLE["period_stats_long"]
ORACLE["bars_from_tick_stream"] = ORACLE["bars_daily"]

ORACLE["scalar_date_parts"] = """
SELECT date_text, CAST(strptime(date_text, '%Y-%m-%d') AS DATE) AS "Date",
       CAST(year(CAST(date_text AS DATE)) AS INTEGER) AS "Year",
       CAST(quarter(CAST(date_text AS DATE)) AS INTEGER) AS "Q",
       strftime(CAST(date_text AS DATE), '%Y-%m') AS "Month",
       CAST(year(CAST(date_text AS DATE)) AS VARCHAR) || '-Q'
         || CAST(quarter(CAST(date_text AS DATE)) AS VARCHAR) AS "Quarter"
FROM (SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS date_text FROM lineitem)"""

# --- stored documents, sinks and manifest ------------------------------------------

_STORED = _with(BARS_CTE) + f"""
SELECT symbol || '|' || strftime("Date", '%Y-%m-%d') AS _id, {_bar_cols()},
       ("Close" - "Open") / "Open" AS "Return", ("Open" + "Close") / 2 AS "AVG Price",
       ("Close" - "Open") / "Open" * 100 AS "Close Pct Change"
FROM bars"""

ORACLE["documents_newest_first"] = _STORED
ORACLE["documents_range"] = _STORED + """
WHERE "Date" BETWEEN DATE '1998-03-01' AND DATE '1998-10-31'"""
ORACLE["documents_by_id"] = f"""SELECT * FROM ({_STORED}) t
WHERE _id IN ('A|1998-03-02', 'N|1998-03-02', 'R|1996-07-01', 'no such id')"""

# Sent twice: each document is there once.
ORACLE["sink_documents"] = ORACLE["to_documents"]

_NATION_SOURCE = """'{"n_nationkey":' || n_nationkey || '}'"""
ORACLE["sink_refused"] = f"""
SELECT 'nation' AS _index, CASE WHEN n_regionkey <> 0 THEN n_name END AS _id,
       CASE WHEN n_regionkey = 1 THEN n_name ELSE {_NATION_SOURCE} END AS _source,
       CASE WHEN n_regionkey = 0 THEN 'no _id' ELSE 'source is not a JSON object' END AS reason
FROM nation WHERE n_regionkey IN (0, 1)"""

ORACLE["declared_target"] = _with(BARS_CTE, _LABELS, _LONG_RAW) + """
SELECT period_type, count(*) AS n, true AS created, false AS created_again,
       true AS other_refused
FROM long_raw GROUP BY 1"""

ORACLE["file_manifest"] = "\nUNION ALL\n".join(
    f"SELECT '{t}.parquet' AS file_name, count(*) AS rows, true AS has_bytes, true AS has_time"
    f" FROM {t}" for t in TABLES)

ORACLE["verify_landed"] = _with(BARS_CTE) + """
, counted AS (SELECT count(*) AS n, count(*) FILTER (WHERE symbol <> 'R') AS part FROM bars)
SELECT 'parquet' AS copy, n AS rows, n AS landed_rows, true AS same FROM counted
UNION ALL SELECT 'csv', n, n, true FROM counted
UNION ALL SELECT 'part', n, part, n = part FROM counted"""

# --- CSV: every line, quoted line breaks, different headers -------------------------

# A line that does not fit keeps the fields that do.
ORACLE["scan_csv_all_lines"] = """
SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS bad_line FROM events
UNION ALL
SELECT NULL, n_name, 'bad-' || n_nationkey || ',' || n_name || ',' || n_name || ','
       || n_name || ',' || n_name || ',' || n_name FROM nation"""

ORACLE["scan_csv_multiline"] = "SELECT * FROM documents"

ORACLE["union_declared_headers"] = _with(BARS_CTE) + """
SELECT symbol, "Date", CASE WHEN symbol = 'R' THEN "Open" END AS "Open", "Close", "Volume",
       CAST(NULL AS VARCHAR) AS bad_line FROM bars
UNION ALL
SELECT n_name, NULL, NULL, NULL, NULL, n_name || ',no date' FROM nation"""

# --- log lines with any payload -----------------------------------------------------

_K = "CAST(json_extract(props, '$.k') AS BIGINT)"
_TS_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"

ORACLE["log_fields"] = f"""
SELECT event_id, '$.event_id' AS path, CAST(event_id AS VARCHAR) AS value FROM events
UNION ALL SELECT event_id, '$.ts', {_TS_TEXT} FROM events
UNION ALL SELECT event_id, '$.event_type', event_type FROM events
UNION ALL SELECT event_id, '$.props.k', CAST({_K} AS VARCHAR) FROM events
UNION ALL SELECT event_id, '$.props.seen[0]', CAST({_K} AS VARCHAR) FROM events
UNION ALL SELECT event_id, '$.props.seen[1]', CAST(user_id AS VARCHAR) FROM events
UNION ALL SELECT event_id, '$[''failed by''].user', CAST(user_id AS VARCHAR) FROM events
WHERE event_type = 'error'"""

ORACLE["log_bad_lines"] = """SELECT '{"broken": "' || n_name AS line FROM nation"""

ORACLE["log_payload_schema"] = """
SELECT 'OBJECT<event_id: BIGINT, event_type: STRING, '
       || CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0
               THEN '`failed by`: OBJECT<user: BIGINT>, ' ELSE '' END
       || 'props: OBJECT<k: BIGINT, seen: ARRAY<BIGINT>>, ts: STRING>' AS schema,
       count(*) AS n
FROM events"""

ORACLE["log_ingest_any_stream"] = f"""
SELECT event_id, event_type, {_TS_TEXT} AS ts FROM events"""

# --- streams: equal to their batch twins --------------------------------------------

ORACLE["retention_sweep_stream"] = ORACLE["retention_sweep"]
ORACLE["uptime_gaps_stream"] = ORACLE["uptime_gaps"]
ORACLE["word_count_stream"] = ORACLE["word_count"]
ORACLE["period_stats_incremental"] = ORACLE["period_stats_long"]

_QUARTILE_COLUMNS = ["Open", "High", "Low", "Close", "Volume"]

ORACLE["period_quartiles"] = _with(BARS_CTE) + f"""
, periods AS (
  SELECT 'monthly' AS period_type, strftime("Date", '%Y-%m') AS period, * FROM bars
  UNION ALL
  SELECT 'quarterly', CAST(year("Date") AS VARCHAR) || '-Q' || CAST(quarter("Date") AS VARCHAR),
         * FROM bars
  UNION ALL
  SELECT 'yearly', CAST(year("Date") AS VARCHAR), * FROM bars)
, cells AS (
  {" UNION ALL ".join(
      f"""SELECT symbol, period_type, period, '{c}' AS "column", CAST("{c}" AS DOUBLE) AS x
          FROM periods""" for c in _QUARTILE_COLUMNS)})
SELECT symbol, period_type, period, "column", count(x) AS n,
       quantile_disc(x, 0.25) AS "25%", quantile_disc(x, 0.5) AS "50%",
       quantile_disc(x, 0.75) AS "75%"
FROM cells GROUP BY ALL"""

ORACLE["period_quartiles_incremental"] = ORACLE["period_quartiles"]

# of both versions of a bar in one trigger the later file's stays
ORACLE["incremental_bars_corrections"] = ORACLE["bars_daily"]

ORACLE["incremental_points"] = _with(BARS_CTE) + f"""
SELECT 'stock_prices,symbol=' || symbol || ' '
         || concat_ws(',', {", ".join(_field(n, x) for n, x in _BAR_FIELDS[:6])})
         || ' ' || CAST(CAST(("Date" - DATE '1970-01-01') AS BIGINT) * 86400000000000 AS VARCHAR)
         AS line
FROM bars"""

_SIZE = "(event_id * event_id * 1000)"
_UNITS = [("TB", 4), ("GB", 3), ("MB", 2), ("KB", 1)]

ORACLE["scalar_epoch_size"] = f"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
       CASE {" ".join(f"WHEN {_SIZE} >= 1024.0 ** {p} THEN "
                      f"format('{{:.2f}} {u}', {_SIZE} / 1024.0 ** {p})" for u, p in _UNITS)}
            ELSE format('{{:.2f}} B', {_SIZE} * 1.0) END AS size_text
FROM events"""
