"""Declared schemas.  Inference is opt-in; operators work on these types."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_COLUMNS = ("Open", "High", "Low", "Close", "Adj Close")

# Daily bar as landed / scanned: key (symbol, Date).
BAR = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("Date", T.DateType(), True),
    T.StructField("Open", T.DoubleType(), True),
    T.StructField("High", T.DoubleType(), True),
    T.StructField("Low", T.DoubleType(), True),
    T.StructField("Close", T.DoubleType(), True),
    T.StructField("Adj Close", T.DoubleType(), True),
    T.StructField("Volume", T.LongType(), True),
])

# Daily bar CSV as downloaded (one file per symbol, no symbol column).
BAR_CSV = T.StructType([
    T.StructField("Date", T.DateType(), True),
    T.StructField("Open", T.DoubleType(), True),
    T.StructField("High", T.DoubleType(), True),
    T.StructField("Low", T.DoubleType(), True),
    T.StructField("Close", T.DoubleType(), True),
    T.StructField("Adj Close", T.DoubleType(), True),
    T.StructField("Volume", T.LongType(), True),
])

# Bar document: bar + derived columns.
STOCK_DOC = T.StructType(list(BAR.fields) + [
    T.StructField("Return", T.DoubleType(), True),
    T.StructField("AVG Price", T.DoubleType(), True),
    T.StructField("Close Pct Change", T.DoubleType(), True),
])

_STAT_FIELDS = [
    T.StructField("Avg_Close", T.DoubleType(), True),
    T.StructField("Total_Volume", T.LongType(), True),
    T.StructField("Avg_High", T.DoubleType(), True),
    T.StructField("Avg_Low", T.DoubleType(), True),
    T.StructField("Avg_Open", T.DoubleType(), True),
    T.StructField("Std_Close", T.DoubleType(), True),
    T.StructField("Trading_Days", T.LongType(), True),
]

MONTHLY = T.StructType([T.StructField("symbol", T.StringType(), True),
                        T.StructField("Month", T.StringType(), True)] + _STAT_FIELDS)
QUARTERLY = T.StructType([T.StructField("symbol", T.StringType(), True),
                          T.StructField("Quarter", T.StringType(), True)] + _STAT_FIELDS)
YEARLY = T.StructType([T.StructField("symbol", T.StringType(), True),
                       T.StructField("Year", T.IntegerType(), True)] + _STAT_FIELDS
                      + [T.StructField("YoY_Growth", T.DoubleType(), True)])

# Target schemas of the document sink, by period (the index mappings).
DOC_TARGETS = {"daily": STOCK_DOC, "monthly": MONTHLY, "quarterly": QUARTERLY,
               "yearly": YEARLY}
