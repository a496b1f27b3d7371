"""CSV scans: declared schema, corrupt-row capture, multi-file union.

W1 (scan with reader defaults a caller may override), W2 (union of files
whose columns differ, missing columns NULL-filled), W3 (corrupt rows kept
with their raw line), W7 (existence check, lenient mode).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Options that differ from Spark's own.  multiLine stays off: it makes every
# file one unsplittable task; turn it on for files with quoted line breaks (MULTILINE).
# Partition discovery stays on (no recursiveFileLookup) so ``year=`` folders
# prune.  Quotes are doubled inside quoted fields; times have microseconds.
CSV_DEFAULTS = {
    "header": "true",
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


# For files whose quoted fields hold line breaks, and blanks that count.
MULTILINE = {"multiLine": "true", "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_csv(spark: SparkSession, paths: str | Sequence[str],
             schema: T.StructType | None = None,
             options: Mapping[str, str] | None = None,
             infer: bool = False, keep_corrupt: bool = True) -> DataFrame:
    """Scan CSV files.

    With a ``schema`` its columns are found by the names in the header,
    whatever their order; a column that a path lacks is NULL, and one that
    the schema does not name is left out.  Each of ``paths`` (a file, folder
    or pattern) has one header, read once; paths that share a header are one
    scan, and a file with another header than its path raises.  If
    ``keep_corrupt``, a nullable ``_corrupt_record`` column holds the raw
    text of any line that does not fit (its other fields NULL where
    unparseable).  Without a schema, columns are strings unless ``infer`` (an
    extra pass over the data).
    """
    paths = _as_list(paths)
    opts = dict(CSV_DEFAULTS)
    opts["inferSchema"] = "true" if (schema is None and infer) else "false"
    if options:
        opts.update({k: str(v) for k, v in options.items()})
    reader = spark.read.format("csv").options(**opts)
    if schema is None:
        return reader.load(paths)
    corrupt = opts.get("columnNameOfCorruptRecord", CORRUPT)
    raw = [T.StructField(corrupt, T.StringType(), True)] if keep_corrupt else []
    declared = {f.name: f for f in schema.fields if f.name != corrupt}
    if str(opts["header"]).lower() != "true":
        return reader.schema(T.StructType([*declared.values(), *raw])).load(paths)
    groups: dict[tuple, list[str]] = {}
    for p in paths:
        header = spark.read.format("csv").options(**opts).load(p).schema.fields
        groups.setdefault(tuple((f.name, f.dataType) for f in header), []).append(p)
    parts = []
    for header, group in groups.items():
        fields = [declared.get(n, T.StructField(n, t, True)) for n, t in header]
        df = (spark.read.format("csv").options(**{**opts, "enforceSchema": "false"})
              .schema(T.StructType([*(fields or declared.values()), *raw])).load(group))
        parts.append(df.select(*[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType))
            .alias(f.name) for f in [*declared.values(), *raw]]))
    return reduce(DataFrame.unionAll, parts)


def _parsed(df: DataFrame, corrupt: str) -> Column:
    """Always true, but references the data columns: Spark refuses a query
    over a raw CSV/JSON scan that needs only the corrupt-record column (for
    instance ``count()`` after filtering on it)."""
    data = [F.col(f"`{c}`") for c in df.columns if c != corrupt]
    # a comparison the optimiser cannot fold away (hash is a 32-bit int)
    return F.hash(*data) >= F.lit(-(2 ** 31)) if data else F.lit(True)


def split_corrupt(df: DataFrame, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows with their raw line).
    Both sides can be counted directly."""
    bad = F.col(corrupt).isNotNull()
    parsed = _parsed(df, corrupt)
    return df.where(~bad & parsed).drop(corrupt), df.where(bad & parsed)


def corrupt_counts(df: DataFrame, corrupt: str = CORRUPT) -> DataFrame:
    """(good_rows, bad_rows).  The good count hashes the data columns so the
    scan parses whole lines (Spark refuses a query over the raw file that
    needs only the corrupt-record column)."""
    flag = F.col(corrupt).isNotNull()
    data = [F.col(f"`{c}`") for c in df.columns if c != corrupt]
    return df.agg(F.count(F.when(~flag, F.hash(*data))).alias("good_rows"),
                  F.count(F.when(flag, F.hash(*data))).alias("bad_rows"))


def read_bar_csv(spark: SparkSession, paths: str | Sequence[str],
                 schema: T.StructType | None = None, symbol: str | None = None,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """Daily bar CSV files -> typed bars (W4 without a driver hop).

    The symbol comes from a ``symbol=<S>`` folder (partition discovery) or
    the ``symbol`` argument; columns are found by their header names, and
    ``Adj Close`` defaults to ``Close`` where it is absent or empty.  Corrupt
    lines are kept with their raw text in
    ``_corrupt_record`` (see ``split_corrupt``).
    """
    from candlestack.schemas import BAR_CSV

    schema = schema or BAR_CSV
    if symbol is None and "symbol" not in schema.fieldNames():
        schema = T.StructType([T.StructField("symbol", T.StringType(), True), *schema.fields])
    df = read_csv(spark, paths, schema, options)
    if symbol is not None:
        df = df.withColumn("symbol", F.lit(symbol))
    if "Adj Close" not in df.columns:
        df = df.withColumn("Adj Close", F.lit(None).cast("double"))
    df = df.withColumn("Adj Close", F.coalesce(
        F.col("`Adj Close`"), F.when(F.col(CORRUPT).isNull(), F.col("Close"))))
    first = ["symbol"] if "symbol" in df.columns else []
    rest = [c for c in df.columns if c not in first]
    return df.select(*first, *[F.col(f"`{c}`") for c in rest])


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """Split paths (files, folders or patterns) into (present, missing): Spark resolves
    each path on the driver and reads no data."""
    present, missing = [], []
    for p in paths:
        try:
            spark.read.text(p)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(p)
        else:
            present.append(p)
    return present, missing


def read_csv_union(spark: SparkSession, paths: Sequence[str],
                   schema: T.StructType | None = None,
                   options: Mapping[str, str] | None = None,
                   lenient: bool = False, infer: bool = False, keep_corrupt: bool = True):
    """Read several CSV files and union them by column name.

    With a declared ``schema`` paths that share a header are a single scan
    (``read_csv``), and lines that do not fit are kept with their text in
    ``_corrupt_record`` (unless not ``keep_corrupt``: then only their fields that fit).  Without one, each path keeps its own header and the union
    NULL-fills columns a path lacks.  ``lenient`` skips missing paths and
    returns ``(df, missing)``; strict mode lets the scan raise.
    """
    paths = _as_list(paths)
    missing: list[str] = []
    if lenient:
        paths, missing = existing_paths(spark, paths)
        if not paths:
            return None, missing
    if schema is not None:
        df = read_csv(spark, paths, schema, options, keep_corrupt=keep_corrupt)
    else:
        parts = [read_csv(spark, p, None, options, infer=infer) for p in paths]
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return (df, missing) if lenient else df
