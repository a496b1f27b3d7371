"""Bars: ticks -> daily OHLCV, split adjustment, derived columns, shaping.

W4 (bars), W9 (coerce with defaults), W10 (NaN / 'NULL' -> NULL), W11 (split
adjust), W12 (derived columns), W13 (normalise), W14 (constant tag).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlestack.functions.dates import micros_of_day
from candlestack.functions.numeric import nan_to_null, safe_div
from candlestack.schemas import BAR, PRICE_COLUMNS

BAR_COLUMNS = [f.name for f in BAR.fields]

# Tie-break for open/close among ticks of one day on the driver's lineitem
# table: (l_orderkey, l_linenumber) alone is not unique there.
LINEITEM_TIEBREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     "l_extendedprice")


# Bits of lineitem's tick order that one number holds: time of day, then
# LINEITEM_TIEBREAK without the price.  Ship times are dates, so their time of day is
# always 0.  Keys of 10^12 orders and 10^10 parts and suppliers fit; larger ones only
# split a bar's partial aggregate, see ``packed_order``.
LINEITEM_BITS = (0, 42, 6, 40, 38)


def _order_parts(ts: str, columns: Sequence[str]) -> list[Column]:
    return [micros_of_day(F.col(ts)), *[F.col(c) for c in columns]]


def packed_order(parts: Sequence[Column], bits: Sequence[int]) -> tuple[Column, Column]:
    """(key, rest) of a tick order of integer columns: ``key`` is one number made of the
    low ``bits`` of each part (a BIGINT up to 63 bits in all, a DECIMAL up to 126), and
    ``rest`` holds what lies above them, NULL where that is nothing.  Among ticks of
    equal ``rest`` keys compare as the tuples do, whatever the values: no range is
    declared, and larger values only give more ``rest`` groups."""
    if len(bits) != len(parts) or sum(bits) > 126 or any(b < 0 or b > 62 for b in bits):
        raise ValueError("one width of at most 62 bits for each part, at most 126 in all")
    high = [F.shiftright(p.cast("long"), b) for p, b in zip(parts, bits)]
    none = high[0] == 0
    for h in high[1:]:
        none = none & (h == 0)
    rest = F.when(none, F.lit(None)).otherwise(
        F.struct(*[h.alias(f"h{i}") for i, h in enumerate(high)]))
    halves = [F.lit(0).cast("long"), F.lit(0).cast("long")]
    over = max(0, sum(bits) - 63)  # bits of the lower number
    left = sum(bits)
    for p, b in zip(parts, bits):
        if not b:
            continue
        low = F.coalesce(p.cast("long"), F.lit(0)).bitwiseAND(F.lit((1 << b) - 1).cast("long"))
        left -= b  # bits below this part
        if left >= over:
            halves[0] = halves[0] + F.shiftleft(low, left - over)
        elif left + b <= over:
            halves[1] = halves[1] + F.shiftleft(low, left)
        else:  # a part that lies in both
            cut = over - left
            halves[0] = halves[0] + F.shiftright(low, cut)
            halves[1] = halves[1] + F.shiftleft(
                low.bitwiseAND(F.lit((1 << cut) - 1).cast("long")), left)
    if not over:
        return halves[0], rest
    return (halves[0].cast("decimal(20,0)") * F.lit(Decimal(2 ** over)).cast("decimal(20,0)")
            + halves[1].cast("decimal(20,0)")).cast("decimal(38,0)"), rest


def unpacked_order(key: Column, rest: Column, bits: Sequence[int]) -> Column:
    """The tuple that ``packed_order`` packed, as a struct that compares as it does."""
    over = max(0, sum(bits) - 63)
    lower = F.lit(0).cast("long")
    if over:
        scale = F.lit(Decimal(2 ** over)).cast("decimal(20,0)")
        lower = (key % scale).cast("long")
        key = ((key - key % scale) / scale).cast("long")
    out, left = [], sum(bits)

    def field(number: Column, at: int, width: int) -> Column:
        return F.shiftright(number, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    for i, b in enumerate(bits):
        out.append(F.when(rest.isNull(), F.lit(0).cast("long")).otherwise(rest[f"h{i}"])
                   .alias(f"h{i}"))
        if not b:
            continue
        left -= b
        if left >= over:
            low = field(key, left - over, b)
        elif left + b <= over:
            low = field(lower, left, b)
        else:
            cut = over - left
            low = F.shiftleft(field(key, 0, b - cut), cut) + field(lower, left, cut)
        out.append(low.alias(f"l{i}"))
    return F.struct(*out)


def duplicate_tick_keys(ticks: DataFrame, columns: Sequence[str], symbol: str, ts: str,
                        ) -> DataFrame:
    """Ticks sharing (symbol, day, time of day, columns): the cases where a
    packed order cannot tell first from last.  A distributed check (partial
    counts per key) for data contracts and tests; empty means the packed
    order is exact."""
    keys = [F.col(symbol), F.to_date(F.col(ts)), micros_of_day(F.col(ts)),
            *[F.col(c) for c in columns]]
    return (ticks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _as_date(x) -> _dt.date:
    return x if isinstance(x, _dt.date) else _dt.date.fromisoformat(str(x))


def _between(ticks: DataFrame, ts: str, start, end) -> DataFrame:
    """Ticks of the inclusive dates ``start`` to ``end``, by the raw column, so that the
    bounds reach the scan."""
    ts_type = ticks.schema[ts].dataType
    if start is not None:
        ticks = ticks.where(F.col(ts) >= F.lit(_as_date(start).isoformat()).cast(ts_type))
    if end is not None:
        nxt = _as_date(end) + _dt.timedelta(days=1)
        ticks = ticks.where(F.col(ts) < F.lit(nxt.isoformat()).cast(ts_type))
    return ticks


def bar_partials(ticks: DataFrame, symbol: str = "l_returnflag", ts: str = "l_shipdate",
                 price: str = "l_extendedprice", qty: str = "l_quantity",
                 tiebreak: Sequence[str] = LINEITEM_TIEBREAK[:-1],
                 bits: Sequence[int] = LINEITEM_BITS) -> DataFrame:
    """(symbol, Date, first, Open, last, Close, High, Low, Volume): bars in parts that
    ``merge_bars`` puts together, with the places of the first and last tick in the
    order (time of day, *tiebreak).  The aggregate over the ticks is hash-based and
    combines a symbol's ticks before the shuffle; a bar has one part for each ``rest``
    of the packed order (one, where the bits hold the values)."""
    key, rest = packed_order(_order_parts(ts, tiebreak), bits)
    parts = (ticks.groupBy(F.col(symbol).alias("symbol"), F.to_date(F.col(ts)).alias("Date"),
                           rest.alias("_rest"))
             .agg(F.min(key).alias("_first"), F.min_by(price, key).alias("Open"),
                  F.max(key).alias("_last"), F.max_by(price, key).alias("Close"),
                  F.max(price).alias("High"), F.min(price).alias("Low"),
                  F.sum(F.col(qty).cast("long")).alias("Volume")))
    return parts.select(
        "symbol", "Date", unpacked_order(F.col("_first"), F.col("_rest"), bits).alias("first"),
        "Open", unpacked_order(F.col("_last"), F.col("_rest"), bits).alias("last"), "Close",
        "High", "Low", "Volume")


def merge_bars(parts: DataFrame) -> DataFrame:
    """Parts of bars (``bar_partials``, of any number of inputs) to one part for each bar."""
    return (parts.groupBy("symbol", "Date")
            .agg(F.min("first").alias("first"), F.min_by("Open", "first").alias("Open"),
                 F.max("last").alias("last"), F.max_by("Close", "last").alias("Close"),
                 F.max("High").alias("High"), F.min("Low").alias("Low"),
                 F.sum("Volume").alias("Volume")))


def bars_of_partials(parts: DataFrame) -> DataFrame:
    """Merged parts as bars."""
    return (parts.withColumn("Adj Close", F.col("Close"))
            .select(*[_q(c) for c in BAR_COLUMNS]))


def bars_from_ticks(ticks: DataFrame, symbol: str = "l_returnflag",
                    ts: str = "l_shipdate", price: str = "l_extendedprice",
                    qty: str = "l_quantity",
                    tiebreak: Sequence[str] = LINEITEM_TIEBREAK,
                    start=None, end=None, seq: str | Column | None = None,
                    bits: Sequence[int] | None = None) -> DataFrame:
    """Daily OHLCV bars keyed (symbol, Date).

    Open/Close are the prices of the first/last tick of the day ordered by
    (ts, *tiebreak); High/Low the extremes; Volume the summed quantity.
    ``start``/``end`` (inclusive dates) filter the raw timestamp column so the
    predicate reaches the Parquet scan.  One aggregation over the ticks, partial
    then final, so a hot symbol is combined map-side before the shuffle.

    Three ways to order ticks: by the struct (ts, *tiebreak), of any types, which
    Spark aggregates sort-based; by ``seq``, one unique number (a trade id), hash-based;
    or, with ``bits``, by integer ``tiebreak`` columns packed into one number
    (``packed_order``), hash-based and exact for all values.  The tuple must identify
    a tick within a bar (``duplicate_tick_keys`` checks it).
    """
    t = _between(ticks, ts, start, end)
    if bits is not None:
        return bars_of_partials(merge_bars(bar_partials(t, symbol, ts, price, qty,
                                                        tiebreak, bits)))
    if seq is not None:
        order_key = F.col(seq) if isinstance(seq, str) else seq
    else:
        order_key = F.struct(F.col(ts), *[F.col(c) for c in tiebreak])
    return (t.groupBy(F.col(symbol).alias("symbol"), F.to_date(F.col(ts)).alias("Date"))
            .agg(F.min_by(price, order_key).alias("Open"),
                 F.max(price).alias("High"),
                 F.min(price).alias("Low"),
                 F.max_by(price, order_key).alias("Close"),
                 F.sum(F.col(qty).cast("long")).alias("Volume"))
            .withColumn("Adj Close", F.col("Close"))
            .select(*[_q(c) for c in BAR_COLUMNS]))


def split_adjust(bars: DataFrame, factor: float = 1.0,
                 columns: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """Divide price columns by a split factor; Volume is left as is."""
    if factor == 1:
        return bars
    present = [c for c in columns if c in bars.columns]
    return bars.withColumns({c: _q(c) / F.lit(float(factor)) for c in present})


def derived_columns(bars: DataFrame) -> DataFrame:
    """Three columns per bar, NULL (not an error) when Open is 0: the move
    within the day relative to the open, the middle of open and close, and the
    move in percent."""
    move = safe_div(F.col("Close") - F.col("Open"), F.col("Open"))
    return bars.withColumns({  # fixed values: the three names
        "Return": move,
        "AVG Price": (F.col("Open") + F.col("Close")) / 2,
        "Close Pct Change": move * 100,
    })


def normalise_bars(df: DataFrame, renames: Mapping[str, str] | None = None,
                   date_as_string: bool = False) -> DataFrame:
    """Rename source columns, default ``Adj Close`` to ``Close`` where absent or
    NULL, and optionally render ``Date`` as ``yyyy-MM-dd`` text."""
    out = df
    if renames:
        out = out.withColumnsRenamed(dict(renames))
    if "Adj Close" in out.columns:
        out = out.withColumn("Adj Close", F.coalesce(_q("Adj Close"), F.col("Close")))
    else:
        out = out.withColumn("Adj Close", F.col("Close"))
    if date_as_string:
        out = out.withColumn("Date", F.date_format(F.col("Date"), "yyyy-MM-dd"))
    return out


def coerce_defaults(df: DataFrame, schema: T.StructType, default=None) -> DataFrame:
    """Project onto ``schema``: cast each field with ``try_cast`` (bad text ->
    NULL); absent fields become NULL.  With ``default`` given, NULLs (absent,
    null or uncastable) of numeric fields become that value."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = _q(f.name).try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if default is not None and isinstance(f.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(default).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def null_normalise(df: DataFrame, null_token: str = "NULL") -> DataFrame:
    """Floating NaN -> NULL, and the string token ``'NULL'`` -> NULL."""
    repl = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            repl[f.name] = nan_to_null(_q(f.name))
        elif isinstance(f.dataType, T.StringType):
            repl[f.name] = F.nullif(_q(f.name), F.lit(null_token))
    return df.withColumns(repl) if repl else df


def with_tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant tag column (symbol, period type, ...)."""
    return df.withColumn(name, F.lit(value))
