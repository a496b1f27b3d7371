"""Rolling analytics over each symbol's bars, ordered by Date.

W15 (close-to-close daily return), W25/W26 (n-row moving averages),
W27 (annualised volatility), W37 (last-n-days analysis).

Definitions follow the pandas ones the reference used: ``pct_change``
(first row NULL), ``rolling(n).mean()`` / ``.std()`` (NULL until n non-null
values are in the frame; sample stddev).  All frames look back only, so they
run on bounded series segments (``operators.series``), or, for bars keyed by
symbol and date (``bounded=True``), whose number the calendar bounds, one task
per symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlestack.functions.numeric import safe_div, sqrt_const
from candlestack.operators.series import DEFAULT_SEG_ROWS, series_columns

# Trading days per year used to annualise volatility.
TRADING_DAYS_PER_YEAR = 252


PREV = "_prev_close"


def _bar_series(bars: DataFrame, halo: int, stages, seg_rows: int,
                bounded: bool) -> DataFrame:
    out = series_columns(bars, keys=["symbol"], order=["Date"], halo=halo,
                         stages=stages, seg_rows=seg_rows, bounded=bounded)
    return out.drop(PREV)


def _prev_stage(w: WindowSpec, price: str = "Close") -> dict[str, Column]:
    """The previous close, computed once and reused by the return."""
    return {PREV: F.lag(price).over(w)}


def _return_expr(price: str = "Close") -> Column:
    return safe_div(F.col(price) - F.col(PREV), F.col(PREV))


def _mean_expr(w: WindowSpec, n: int, col: str = "Close") -> Column:
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(col).over(frame) == n, F.avg(col).over(frame))


def _vol_expr(w: WindowSpec, n: int, col: str, periods: int) -> Column:
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(col).over(frame) == n,
                  F.stddev_samp(col).over(frame) * sqrt_const(periods))


def daily_return(bars: DataFrame, out: str = "Daily Return",
                 seg_rows: int = DEFAULT_SEG_ROWS, bounded: bool = False) -> DataFrame:
    return _bar_series(bars, 1, lambda w: [_prev_stage(w), {out: _return_expr()}],
                       seg_rows, bounded)


def moving_average(bars: DataFrame, n: int, out: str | None = None,
                   seg_rows: int = DEFAULT_SEG_ROWS, bounded: bool = False) -> DataFrame:
    out = out or f"MA{n}"
    return _bar_series(bars, n - 1, lambda w: [{out: _mean_expr(w, n)}], seg_rows,
                       bounded)


def volatility(bars: DataFrame, n: int = 20, periods: int = TRADING_DAYS_PER_YEAR,
               out: str = "Volatility", seg_rows: int = DEFAULT_SEG_ROWS,
               bounded: bool = False) -> DataFrame:
    """n-row sample stddev of the daily return, annualised by sqrt(periods).
    Needs n returns, so the first value appears at row n+1."""
    return _bar_series(
        bars, n,
        lambda w: [_prev_stage(w), {"Daily Return": _return_expr()},
                   {out: _vol_expr(w, n, "Daily Return", periods)}],
        seg_rows, bounded)


def rolling_analytics(bars: DataFrame, ma: tuple[int, ...] = (5, 20), vol_n: int = 20,
                      periods: int = TRADING_DAYS_PER_YEAR,
                      seg_rows: int = DEFAULT_SEG_ROWS,
                      bounded: bool = False) -> DataFrame:
    """Daily Return, MA5, MA20 and Volatility in one segmented window pass."""
    halo = max([vol_n] + [n - 1 for n in ma])

    def stages(w):
        first = _prev_stage(w)
        first.update({f"MA{n}": _mean_expr(w, n) for n in ma})
        return [first, {"Daily Return": _return_expr()},
                {"Volatility": _vol_expr(w, vol_n, "Daily Return", periods)}]

    return _bar_series(bars, halo, stages, seg_rows, bounded)


def last_n_days(bars: DataFrame, days: int = 30, as_of=None) -> DataFrame:
    """Bars with Date in [as_of - days, as_of] (inclusive).  ``as_of`` defaults
    to the latest Date in the data (a scalar subquery), keeping runs
    reproducible rather than tied to the wall clock."""
    end = (F.lit(str(as_of)).cast("date") if as_of is not None
           else bars.select(F.max("Date")).scalar())
    return bars.where(F.col("Date").between(F.date_sub(end, days), end))


def analyze_last_n_days(bars: DataFrame, days: int = 30, as_of=None,
                        seg_rows: int = DEFAULT_SEG_ROWS) -> DataFrame:
    """Slice the last ``days`` calendar days, then returns / MAs / volatility
    within the slice (the slice's first row has no return).  Bars are keyed
    (symbol, Date), so a symbol has at most ``days + 1`` rows in the slice:
    the windows run per symbol."""
    return rolling_analytics(last_n_days(bars, days, as_of), seg_rows=seg_rows,
                             bounded=True)
