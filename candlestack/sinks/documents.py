"""Documents routed to one target per period (W33) with declared target
schemas (W34).

A document is ``_id`` (a deterministic key, so re-runs replace rather than
duplicate), ``_index`` (the target) and ``_source`` (the row as JSON).  The
declared schema is applied with ``DataFrame.to`` (reorder, cast, fail on
missing non-nullable fields) before rendering.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlestack.schemas import STOCK_DOC

# Declared schema of the long period-statistics documents.
STATS_DOC = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("period_type", T.StringType(), True),
    T.StructField("period", T.StringType(), True),
    T.StructField("period_start", T.DateType(), True),
    T.StructField("Avg_Close", T.DoubleType(), True),
    T.StructField("Total_Volume", T.LongType(), True),
    T.StructField("Avg_High", T.DoubleType(), True),
    T.StructField("Avg_Low", T.DoubleType(), True),
    T.StructField("Avg_Open", T.DoubleType(), True),
    T.StructField("Std_Close", T.DoubleType(), True),
    T.StructField("Trading_Days", T.LongType(), True),
    T.StructField("YoY_Growth", T.DoubleType(), True),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a declared target schema (column order and types)."""
    return df.to(schema)


class TargetMismatch(ValueError):
    """A target exists with another schema than the declared one."""


def target_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema that ``create_target`` declared for ``path``; None where no target is."""
    try:
        stored = spark.read.text(f"{path.rstrip('/')}/_schema").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(stored[0]))


def create_target(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Declares an empty target with ``schema`` unless it exists.  True if it was created,
    False if a target of the same schema was there and is left as it is; a target of
    another schema raises ``TargetMismatch`` with the columns that differ.

    The schema is stored beside the data (``_schema``, which scans skip), so it also
    holds for formats that carry none."""
    stored = target_schema(spark, path)
    if stored is None:
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(
            f"{path.rstrip('/')}/_schema")
        return True
    want, have = ({f.name: f.dataType for f in s.fields} for s in (schema, stored))
    differ = sorted(n for n in want.keys() | have.keys() if want.get(n) != have.get(n))
    if differ:
        raise TargetMismatch(f"{path}: declared schema differs in {', '.join(differ)}")
    return False


def write_target(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Writes ``df`` to a declared target, conformed to its schema (by name; a missing
    column or one that does not cast safely raises)."""
    schema = target_schema(df.sparkSession, path)
    if schema is None:
        raise TargetMismatch(f"{path}: no target is declared")
    conform(df, schema).write.mode(mode).format(fmt).save(f"{path.rstrip('/')}/data")


def to_documents(df: DataFrame, id_cols: Sequence[str], index: str | Column,
                 schema: T.StructType | None = None) -> DataFrame:
    src = conform(df, schema) if schema is not None else df
    doc_id = F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in id_cols])
    target = F.lit(index) if isinstance(index, str) else index
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in src.columns]),
                     {"ignoreNullFields": "false"})
    return src.select(doc_id.alias("_id"), target.alias("_index"), body.alias("_source"))


def stats_documents(long_stats: DataFrame, prefix: str = "stock_") -> DataFrame:
    """Period statistics, one target per level: ``{prefix}{period_type}``."""
    return to_documents(long_stats, ["symbol", "period_type", "period"],
                        F.concat(F.lit(prefix), F.col("period_type")), STATS_DOC)


def bar_documents(derived_bars: DataFrame, index: str = "stock_daily") -> DataFrame:
    return to_documents(derived_bars, ["symbol", "Date"], index, STOCK_DOC)


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one folder per target."""
    docs.write.mode(mode).partitionBy("_index").json(path)


def store_documents(df: DataFrame, path: str, id_cols: Sequence[str], date_col: str = "Date",
                    mode: str = "overwrite") -> str:
    """Typed documents (``_id`` and the columns of ``df``) as Parquet made for reading by
    date and by id: sorted by date, so that files and row groups hold narrow date ranges
    and a range read skips the others by their statistics, in folders by year, with a
    bloom filter on ``_id``, so that a look-up skips row groups that lack it."""
    doc_id = F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in id_cols])
    out = df.select(doc_id.alias("_id"), "*").withColumn("year", F.year(date_col))
    (out.repartitionByRange("year", date_col, "_id")
     .sortWithinPartitions("year", date_col, "_id").write.mode(mode)
     .option("parquet.bloom.filter.enabled#_id", "true")
     .option("parquet.bloom.filter.adaptive.enabled#_id", "true")
     .partitionBy("year").parquet(path))
    return path


def stored_documents(spark: SparkSession, path: str, start=None, end=None,
                     date_col: str = "Date") -> DataFrame:
    """Stored documents of the inclusive dates: years outside are not listed, row groups
    outside are not read."""
    from candlestack.operators.paging import date_range

    docs = spark.read.parquet(path)
    if start is None and end is None:
        return docs.drop("year")
    return date_range(docs, start, end).drop("year")


def documents_by_id(spark: SparkSession, path: str, ids: Sequence[str]) -> DataFrame:
    """Stored documents of ``ids``: an IN filter that the scan tests against the bloom
    filters of the row groups."""
    return spark.read.parquet(path).where(F.col("_id").isin(list(ids))).drop("year")
