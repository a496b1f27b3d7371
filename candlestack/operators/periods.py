"""Period statistics over daily bars.

W16 (monthly / quarterly / yearly stats), W17 (all three levels in one scan
via GROUPING SETS), W18 (rounded monthly analysis), W24 (year-over-year
growth), W29 (first day of each period).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlestack.functions.dates import month_label, period_start, quarter_label
from candlestack.functions.numeric import avg_rounded, finite, safe_div

LEVELS = ("monthly", "quarterly", "yearly")
_LABEL = {"monthly": "Month", "quarterly": "Quarter", "yearly": "Year"}

# Names of the period statistics, in output order.
STAT_COLUMNS = ["Avg_Close", "Total_Volume", "Avg_High", "Avg_Low", "Avg_Open",
                "Std_Close", "Trading_Days"]


def _stat_aggs(digits: int | None = None) -> list[Column]:
    """The period statistics.  With ``digits`` the averages are exact means
    rounded half-up (decimal arithmetic, see ``avg_rounded``) and the raw
    close average is kept as ``_ac_raw`` for growth rates."""
    def mean(c):
        return F.avg(finite(F.col(c))) if digits is None else avg_rounded(F.col(c), digits)
    aggs = [mean("Close").alias("Avg_Close"),
            F.sum("Volume").alias("Total_Volume"),
            mean("High").alias("Avg_High"),
            mean("Low").alias("Avg_Low"),
            mean("Open").alias("Avg_Open"),
            F.stddev_samp(finite(F.col("Close"))).alias("Std_Close"),
            F.count(F.lit(1)).alias("Trading_Days")]
    if digits is not None:
        aggs.append(F.avg(finite(F.col("Close"))).alias("_ac_raw"))
    return aggs


def with_period_labels(bars: DataFrame) -> DataFrame:
    return bars.withColumns({"Year": F.year("Date"), "Quarter": quarter_label("Date"),
                             "Month": month_label("Date")})


def period_stats(bars: DataFrame, level: str, digits: int | None = None,
                 keep_raw: bool = False) -> DataFrame:
    """Stats per (symbol, period) for one level; hash aggregate, partial+final.
    ``keep_raw`` keeps the unrounded close mean (``_ac_raw``) for growth."""
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    label = _LABEL[level]
    src = bars.withColumn(label, {"monthly": month_label("Date"),
                                  "quarterly": quarter_label("Date"),
                                  "yearly": F.year("Date")}[level])
    out = src.groupBy("symbol", label).agg(*_stat_aggs(digits))
    return out if keep_raw else out.drop("_ac_raw")


def monthly_stats(bars: DataFrame, digits: int | None = None) -> DataFrame:
    return period_stats(bars, "monthly", digits)


def quarterly_stats(bars: DataFrame, digits: int | None = None) -> DataFrame:
    return period_stats(bars, "quarterly", digits)


def yoy_growth(yearly: DataFrame, value: str = "Avg_Close",
               out: str = "YoY_Growth") -> DataFrame:
    """(value - previous present year's value) / previous x 100.

    ``lag`` runs over rows (a missing year compares with the last present
    one).  The window is partitioned by symbol; its input is one row per
    symbol-year, so each task holds a few rows per year of history.
    """
    if "_ac_raw" in yearly.columns and value == "Avg_Close":
        value = "_ac_raw"          # growth from the unrounded mean
    w = Window.partitionBy("symbol").orderBy("Year")
    with_prev = yearly.withColumn("_prev", F.lag(value).over(w))   # computed once
    return (with_prev.withColumn(out, safe_div(F.col(value) - F.col("_prev"), F.col("_prev"))
                                 * 100)
            .drop("_prev", "_ac_raw"))


def yearly_stats(bars: DataFrame, digits: int | None = None) -> DataFrame:
    return yoy_growth(period_stats(bars, "yearly", digits, keep_raw=True))


def period_type_of_set() -> Column:
    """The level of a grouping set's row; a bit of ``_set`` tells which of (symbol, Year,
    Quarter, Month) is grouped out."""
    return (F.when(F.col("_set") == 0b0110, F.lit("monthly"))
            .when(F.col("_set") == 0b0101, F.lit("quarterly"))
            .otherwise(F.lit("yearly")))


def _with_growth(long: DataFrame, raw: str) -> DataFrame:
    """YoY_Growth of the yearly rows, from the unrounded mean ``raw``."""
    w = Window.partitionBy("symbol", "period_type").orderBy("period")
    long = long.withColumn("_prev", F.lag(raw).over(w))            # computed once
    return long.withColumn(
        "YoY_Growth",
        F.when(F.col("period_type") == "yearly",
               safe_div(F.col(raw) - F.col("_prev"), F.col("_prev")) * 100)
    ).drop("_prev", "_ac_raw")


def period_stats_long(bars: DataFrame, with_start: bool = True,
                      digits: int | None = None) -> DataFrame:
    """All three levels in one scan: GROUPING SETS over (symbol, level label).

    Columns: symbol, period_type, period (label text), the stats, YoY_Growth
    (yearly rows only) and period_start.  One Expand feeds one partial
    aggregate, so the bars are read and shuffled once instead of three times.
    """
    labelled = with_period_labels(bars)
    g = (labelled.groupingSets([["symbol", "Year"], ["symbol", "Quarter"],
                                ["symbol", "Month"]],
                               "symbol", "Year", "Quarter", "Month")
         .agg(F.grouping_id().alias("_set"), *_stat_aggs(digits)))
    long = g.select(
        "symbol", period_type_of_set().alias("period_type"),
        F.coalesce("Month", "Quarter", F.col("Year").cast("string")).alias("period"),
        *STAT_COLUMNS, *(["_ac_raw"] if digits is not None else []))
    long = _with_growth(long, "_ac_raw" if digits is not None else "Avg_Close")
    if with_start:
        long = long.withColumn("period_start", period_start(F.col("period_type"),
                                                            F.col("period")))
    return long


# --- statistics that merge ----------------------------------------------------------

_MEANS = {"Avg_Close": "Close", "Avg_High": "High", "Avg_Low": "Low", "Avg_Open": "Open"}
PERIOD_KEYS = ["symbol", "period_type", "period"]


def period_moments(bars: DataFrame) -> DataFrame:
    """Partial statistics by month, quarter and year in one scan: for each of the four
    prices an exact decimal sum and its count, for the close also the sum of squared
    deviations from its own mean, and volume and days.  ``merge_moments`` combines the
    moments of disjoint sets of bars, so an increment never reads history."""
    aggs = []
    for c in _MEANS.values():
        x = finite(F.col(c))
        aggs += [F.sum(x.cast("decimal(30,10)")).alias(f"sum_{c}"), F.count(x).alias(f"n_{c}")]
    labelled = with_period_labels(bars)
    g = (labelled.groupingSets([["symbol", "Year"], ["symbol", "Quarter"], ["symbol", "Month"]],
                               "symbol", "Year", "Quarter", "Month")
         .agg(F.grouping_id().alias("_set"), *aggs,
              F.coalesce(F.var_pop(finite(F.col("Close"))) * F.count(finite(F.col("Close"))),
                         F.lit(0.0)).alias("m2"),
              F.sum("Volume").alias("Total_Volume"), F.count(F.lit(1)).alias("Trading_Days")))
    return g.select("symbol", period_type_of_set().alias("period_type"),
                    F.coalesce("Month", "Quarter", F.col("Year").cast("string")).alias("period"),
                    *[f"{k}_{c}" for c in _MEANS.values() for k in ("sum", "n")],
                    "m2", "Total_Volume", "Trading_Days")


def merge_moments(parts: DataFrame) -> DataFrame:
    """Moments of disjoint sets of bars to those of their union.  Squared deviations
    move to the common mean: m2 + n (mean - common mean)^2, summed."""
    w = Window.partitionBy(*PERIOD_KEYS)  # a row for each set that was written
    mean = (F.col("sum_Close") / F.col("n_Close")).cast("double")
    common = (F.sum("sum_Close").over(w) / F.sum("n_Close").over(w)).cast("double")
    moved = parts.withColumn("m2", F.col("m2") + F.coalesce(
        F.col("n_Close") * F.pow(mean - common, F.lit(2.0)), F.lit(0.0)))
    cols = [c for c in parts.columns if c not in PERIOD_KEYS]
    kinds = dict(parts.dtypes)
    return moved.groupBy(*PERIOD_KEYS).agg(
        *[F.sum(c).cast(kinds[c]).alias(c) for c in cols])


def stats_of_moments(moments: DataFrame, digits: int | None = None) -> DataFrame:
    """Merged moments as ``period_stats_long`` of the bars they stand for."""
    def mean(c):
        exact = F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}"))
        return exact.cast("double") if digits is None else F.round(exact, digits).cast("double")

    n = F.col("n_Close")
    long = moments.select(
        *PERIOD_KEYS, *[mean(c).alias(k) for k, c in _MEANS.items()],
        F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("Std_Close"),
        "Total_Volume", "Trading_Days",
        F.try_divide(F.col("sum_Close"), n).cast("double").alias("_ac_raw"))
    return _with_growth(long.select(*PERIOD_KEYS, *STAT_COLUMNS, "_ac_raw"), "_ac_raw").withColumn(
        "period_start", period_start(F.col("period_type"), F.col("period")))


def monthly_analysis(bars: DataFrame) -> DataFrame:
    """Monthly average close rounded to 2 digits and total volume."""
    return (bars.withColumn("Month", month_label("Date"))
            .groupBy("symbol", "Month")
            .agg(avg_rounded(F.col("Close"), 2).alias("Avg_Close"),
                 F.sum("Volume").alias("Total_Volume")))
