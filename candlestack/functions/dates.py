"""Date labels used as period keys and their inverse (label -> first day)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_of(date: str | Column) -> Column:
    return F.year(_c(date))


def month_label(date: str | Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(_c(date), "yyyy-MM")


def quarter_label(date: str | Column) -> Column:
    """``yyyy-Qn``."""
    d = _c(date)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def period_start(period_type: str | Column, label: str | Column) -> Column:
    """First day of a period from its label.

    ``monthly`` takes ``yyyy-MM``, ``quarterly`` takes ``yyyy-Qn`` (first month
    3n-2) and ``yearly`` takes the year.  ``period_type`` may be a literal
    string or a column holding one of the three names.
    """
    pt = F.lit(period_type) if isinstance(period_type, str) else period_type
    lab = _c(label).cast("string")
    year = F.substring(lab, 1, 4).cast("int")
    quarter = F.element_at(F.split(lab, "-Q"), 2).cast("int")
    return (F.when(pt == "monthly", F.to_date(F.concat(lab, F.lit("-01")), "yyyy-MM-dd"))
            .when(pt == "quarterly", F.make_date(year, quarter * 3 - 2, F.lit(1)))
            .when(pt == "yearly", F.make_date(year, F.lit(1), F.lit(1))))


def epoch_millis_text(ms: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch milliseconds as timestamp text (session time zone)."""
    return F.date_format(F.timestamp_millis(_c(ms)), fmt)


def micros_of_day(ts: str | Column) -> Column:
    """Wall-clock microseconds since midnight, read from the fields (no time
    zone conversion, so exact for TIMESTAMP_NTZ in any session)."""
    c = _c(ts)
    return (F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000
            + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long"))


def wall_clock_micros(ts: str | Column) -> Column:
    """Microseconds of the wall-clock reading since 1970-01-01 00:00 (field
    arithmetic, no time-zone conversion): differences of two readings are
    wall-clock durations, also across daylight-saving changes."""
    c = _c(ts)
    return F.unix_date(F.to_date(c)).cast("long") * 86_400_000_000 + micros_of_day(c)


def truncate_wall_clock(ts: str | Column, unit: str) -> Column:
    """TIMESTAMP_NTZ truncated to ``day``, ``hour`` or ``minute`` from its
    fields (``date_trunc`` would round-trip through the session zone)."""
    c = _c(ts)
    hour = F.hour(c) if unit in ("hour", "minute") else F.lit(0)
    minute = F.minute(c) if unit == "minute" else F.lit(0)
    if unit not in ("day", "hour", "minute"):
        raise ValueError("unit must be day, hour or minute")
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), hour, minute,
                                F.lit(0))
