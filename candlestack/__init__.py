"""candlestack: Spark-native analytics for daily OHLCV time series.

Every operator takes DataFrames (plus plain parameters) and returns a
DataFrame built from built-in Spark expressions, so Catalyst plans the
whole job: scans prune columns and push filters, aggregations run
partial/final, and ordered-series windows run over bounded segments
(``operators.series``) instead of one task per series key.
"""

__version__ = "0.1.0"
