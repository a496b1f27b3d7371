"""Numeric helpers: guarded division, NaN handling, output rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_div(num: Column, den: Column) -> Column:
    """NULL instead of an error (ANSI) when ``den`` is 0 or NULL."""
    return F.try_divide(num, den)


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def finite(c: Column) -> Column:
    """NULL for NaN and infinities: they count as missing in every mean."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)  # NaN sorts above infinity


def avg_rounded(c: Column, digits: int = 2) -> Column:
    """Average rounded half-up to ``digits``, computed in exact decimal.

    A double ``avg`` carries summation-order noise in its last bits, so a
    mean that is exactly halfway (cent prices: 62219.515) rounds either way
    depending on partitioning.  Summing as DECIMAL makes the result exact and
    independent of the plan.
    """
    return F.round(F.avg(finite(c).cast("decimal(30,10)")), digits).cast("double")


def sqrt_const(x: float) -> Column:
    return F.sqrt(F.lit(float(x)))


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (presentation / cross-engine comparison)."""
    cols = {f.name: F.round(F.col(f"`{f.name}`"), digits)
            for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(cols) if cols else df
