"""Time-series points in line protocol (W30).

``measurement,tag=v,... field=v,... time_ns`` built with JVM-side string
functions; NULL tags and fields are left out, integer fields carry an ``i``
suffix, empty tags and non-finite fields are left out too, and the time is exact nanoseconds from the date (time-zone free).
Rendering is a projection, so it runs wherever the rows are; writing is a
plain ``text`` sink (or any writer fed from ``line``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestack.functions.dates import period_start
from candlestack.functions.numeric import finite

NS_PER_DAY = 86_400 * 1_000_000_000


def _c(x: str | Column) -> Column:
    return F.col(f"`{x}`") if isinstance(x, str) else x


def escape_key(c: Column) -> Column:
    """Escape commas, equals signs and spaces in tag keys and values; a line
    break, which would end the point, becomes a space."""
    return F.regexp_replace(F.translate(c, "\r\n", "  "), r"([,= ])", r"\\$1")


def number_text(c: Column, digits: int | None = None) -> Column:
    """Decimal text of a number.  With ``digits`` it is rounded and written
    in plain notation without trailing zeros (stable across engines);
    without, Spark's shortest round-trip text of the double.  NaN and
    infinities have no text (NULL)."""
    x = finite(c.cast("double"))
    if digits is None:
        return x.cast("string")
    s = F.round(x, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.rtrim(F.rtrim(s, F.lit("0")), F.lit(".")) if digits > 0 else s


def date_ns(d: Column) -> Column:
    return F.unix_date(d).cast("long") * F.lit(NS_PER_DAY)


def to_points(df: DataFrame, measurement: str, tags: Mapping[str, str | Column],
              fields: Mapping[str, str | Column], time_ns: Column,
              int_fields: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Add ``time_ns`` and ``line``; rows with no non-NULL field are dropped
    (a point needs at least one field)."""
    m = F.regexp_replace(F.lit(measurement), r"([, ])", r"\\$1")
    tag_parts = [F.concat(F.lit(k + "="), F.nullif(escape_key(_c(v).cast("string")), F.lit("")))
                 for k, v in tags.items()]
    field_parts = []
    for k, v in fields.items():
        val = (F.concat(_c(v).cast("long").cast("string"), F.lit("i")) if k in int_fields
               else number_text(_c(v), digits))
        field_parts.append(F.concat(F.lit(k + "="), val))
    field_set = F.concat_ws(",", *field_parts)
    key = F.concat_ws(",", m, *tag_parts)
    out = df.withColumn("time_ns", time_ns).withColumn("_fields", field_set)
    return (out.where(F.col("_fields") != "")
            .withColumn("line", F.concat_ws(" ", key, F.col("_fields"),
                                            F.col("time_ns").cast("string")))
            .drop("_fields"))


# Field names of the bar and statistics points.
BAR_POINT_FIELDS = {"open": "Open", "high": "High", "low": "Low", "close": "Close",
                    "adj_close": "Adj Close", "volume": "Volume", "return": "Return",
                    "avg_price": "AVG Price", "close_pct_change": "Close Pct Change"}
STAT_POINT_FIELDS = {"avg_close": "Avg_Close", "total_volume": "Total_Volume",
                     "avg_high": "Avg_High", "avg_low": "Avg_Low", "avg_open": "Avg_Open",
                     "std_close": "Std_Close", "trading_days": "Trading_Days",
                     "yoy_growth": "YoY_Growth"}


# Measurement names of bar points and of statistics points.
BAR_MEASUREMENT = "stock_prices"
STATS_MEASUREMENT = "stock_aggregated_stats"


def bar_points(derived_bars: DataFrame, measurement: str = BAR_MEASUREMENT,
               digits: int | None = None) -> DataFrame:
    """Daily bars (with derived columns) as points tagged by symbol."""
    fields = {k: v for k, v in BAR_POINT_FIELDS.items() if v in derived_bars.columns}
    return to_points(derived_bars, measurement, {"symbol": "symbol"}, fields,
                     date_ns(F.col("Date")), digits=digits)


def stats_points(long_stats: DataFrame, measurement: str = STATS_MEASUREMENT,
                 digits: int | None = None) -> DataFrame:
    """Period statistics (long form) as points: tags symbol, period_type and
    month / quarter / year by level; time = first day of the period."""
    pt = F.col("period_type")
    tags = {"symbol": "symbol", "period_type": "period_type",
            "month": F.when(pt == "monthly", F.col("period")),
            "quarter": F.when(pt == "quarterly", F.col("period")),
            "year": F.when(pt == "yearly", F.col("period"))}
    start = (F.col("period_start") if "period_start" in long_stats.columns
             else period_start(pt, F.col("period")))
    return to_points(long_stats, measurement, tags, STAT_POINT_FIELDS, date_ns(start),
                     int_fields=("trading_days",), digits=digits)


def write_points(points: DataFrame, path: str, mode: str = "append") -> None:
    points.select("line").write.mode(mode).text(path)
