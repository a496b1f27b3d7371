"""File manifest, preview and verification (W36): what landed, how big, how many
rows, and whether it is what was sent.

The list of files comes from a metadata-only listing (a ``binaryFile`` scan
without its content), so files without rows appear; rows per file come from
the hidden ``_metadata`` columns of a scan that decodes no data column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def human_size(b: Column) -> Column:
    """Bytes as text in B / KB / MB / GB / TB (1024-based, 2 digits, a tie to the even
    one); NULL for NULL."""
    x = b.cast("double")
    expr = None
    for power, name in enumerate(["B", "KB", "MB", "GB", "TB"]):
        scale = 1024.0 ** power
        text = F.concat(F.format_string("%.2f", F.bround(x / scale, 2)), F.lit(f" {name}"))
        expr = F.when(x.isNotNull(), text) if expr is None else (
            F.when(x >= scale, text).otherwise(expr))
    return expr


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, file_name, file_size, modified) of every file under ``path``, empty
    ones too.  Only the listing is read."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))
    return found.select(F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_name").alias("file_name"),
                        F.col("length").alias("file_size"),
                        F.col("modificationTime").alias("modified"))


def file_manifest(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                  options: dict | None = None) -> DataFrame:
    """One row per file: name, size, modification time (and as text),
    readable size, rows (0 for a file without any)."""
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format(fmt).options(**(options or {}))
    rows = (reader.load(paths).select(F.col("_metadata.file_path").alias("file_path"))
            .groupBy("file_path").agg(F.count(F.lit(1)).alias("rows")))
    return (list_files(spark, paths).join(rows, "file_path", "left")
            .withColumn("rows", F.coalesce("rows", F.lit(0)))
            .withColumn("size_text", human_size(F.col("file_size")))
            .withColumn("modified_text", F.date_format("modified", "yyyy-MM-dd HH:mm:ss")))


def preview_lines(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """First ``n`` lines of a text file.  The limit stops the scan after the
    first split instead of reading the whole file."""
    return spark.read.text(path).limit(n)


def table_digest(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(rows, digest, mixed): an order-free digest of a table's rows, one aggregate that
    combines before its shuffle.  Row hashes are summed, so a row that is there twice
    counts twice; ``mixed`` sums hashes of another seed."""
    cols = [F.col(f"`{c}`") for c in sorted(columns or df.columns)]
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).alias("digest"),
                  F.sum(F.xxhash64(F.lit(1), *cols).cast("decimal(20,0)")).alias("mixed"))


def verify_landed(source: DataFrame, landed: DataFrame) -> DataFrame:
    """(rows, landed_rows, same): a table against its source, over the source's columns.
    ``same``: equal as multisets of rows, but for the chance of 128-bit hashes."""
    sides = [table_digest(source), table_digest(
        landed.select(*[F.col(f"`{c}`") for c in source.columns]))]
    # one row a side, set beside each other by an aggregate
    both = sides[0].withColumn("side", F.lit(0)).unionAll(sides[1].withColumn("side", F.lit(1)))
    picked = both.agg(*[F.max(F.when(F.col("side") == i, F.col(c))).alias(f"{c}{i}")
                        for i in (0, 1) for c in ("rows", "digest", "mixed")])
    same = F.lit(True)
    for c in ("rows", "digest", "mixed"):
        same = same & F.col(f"{c}0").eqNullSafe(F.col(f"{c}1"))
    return picked.select(F.col("rows0").alias("rows"), F.col("rows1").alias("landed_rows"),
                         same.alias("same"))
