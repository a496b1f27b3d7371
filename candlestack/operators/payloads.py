"""Log lines with any JSON payload (R2): nothing declared, no key lost.

A line is parsed once into a VARIANT (``try_parse_json``), which keeps every
key, nested objects and arrays.  Lines that do not parse are a second output
with their text, never dropped.  From the variant come

* ``payload_fields``: one row per leaf, whatever the payload holds;
* ``payload_schema``: the schema that all payloads have together (an
  aggregate, partial before its shuffle);
* ``typed_payload``: columns of a schema, declared or found, by ``try_variant_get``.

All of it runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAYLOAD = "payload"


def parse_lines(lines: DataFrame, text: str = "value", out: str = PAYLOAD) -> DataFrame:
    """``lines`` with ``out``: the payload as VARIANT, NULL where the text is NULL or
    is not JSON.  (JSON ``null`` is a payload: a variant null, not NULL.)"""
    return lines.withColumn(out, F.try_parse_json(F.col(f"`{text}`")))


def split_lines(parsed: DataFrame, text: str = "value",
                out: str = PAYLOAD) -> tuple[DataFrame, DataFrame]:
    """(lines with a payload, without their text; lines without one, with it).  A NULL
    text is no line and is in neither; a blank one is a bad line."""
    good = parsed.where(F.col(out).isNotNull()).drop(text)
    bad = parsed.where(F.col(out).isNull() & F.col(f"`{text}`").isNotNull()).drop(out)
    return good, bad


def _step(key: Column) -> Column:
    """A step of a path: ``.key``, or the key in quotes where it is no plain name."""
    plain = key.rlike(r"^[A-Za-z_][A-Za-z0-9_]*$")
    quote = F.when(F.contains(key, F.lit("'")), F.lit('"')).otherwise(F.lit("'"))
    return F.when(plain, F.concat(F.lit("."), key)).otherwise(
        F.concat(F.lit("["), quote, key, quote, F.lit("]")))


def payload_fields(good: DataFrame, keep: list[str], out: str = PAYLOAD,
                   depth: int = 8) -> DataFrame:
    """(*keep, path, kind, value): one row per leaf of every payload.  ``path`` is a
    JSON path from ``$``, ``kind`` the leaf's type, ``value`` its text (NULL for a JSON
    null).  Empty objects and arrays are leaves.  What lies deeper than ``depth`` levels
    comes out as one leaf with its JSON text, so nothing is lost.

    One pass without a shuffle: each level replaces the containers by their members."""
    explode = good.sparkSession.tvf.variant_explode_outer
    rows = good.select(*keep, F.lit("$").alias("path"), F.col(out).alias("v"))

    def container() -> Column:
        kind = F.schema_of_variant("v")
        return ((kind.startswith("OBJECT<") & (kind != "OBJECT<>"))
                | (kind.startswith("ARRAY<") & (F.to_json("v") != "[]")))

    for _ in range(depth):
        t = rows.withColumn("open", container()).alias("t")
        members = F.when(F.col("t.open"), F.col("t.v"))
        item = F.concat(F.lit("["), F.col("x.pos").cast("string"), F.lit("]"))
        step = F.when(F.col("x.key").isNull(), item).otherwise(_step(F.col("x.key")))
        rows = t.lateralJoin(explode(members.outer()).alias("x")).select(
            *[F.col(f"t.{c}") for c in keep],
            F.when(F.col("t.open"), F.concat("t.path", step)).otherwise(F.col("t.path"))
            .alias("path"),
            F.when(F.col("t.open"), F.col("x.value")).otherwise(F.col("t.v")).alias("v"))
    kind = F.schema_of_variant("v")
    nested = kind.startswith("OBJECT<") | kind.startswith("ARRAY<")
    return rows.select(*keep, "path", kind.alias("kind"),
                       F.when(nested, F.to_json("v"))
                       .otherwise(F.try_variant_get("v", "$", "string")).alias("value"))


def payload_schema(good: DataFrame, out: str = PAYLOAD) -> DataFrame:
    """(schema, n): the least schema that holds all payloads, as a DDL text."""
    return good.agg(F.schema_of_variant_agg(out).alias("schema"), F.count(out).alias("n"))


def typed_payload(good: DataFrame, schema: T.StructType, out: str = PAYLOAD) -> DataFrame:
    """The payload's top-level keys of ``schema`` as columns; a key that is absent or
    does not fit its type is NULL."""
    def name(key: str) -> str:
        quote = '"' if "'" in key else "'"
        if quote in key:
            raise ValueError(f"a key with both kinds of quotes has no path: {key}")
        return f"$[{quote}{key}{quote}]"

    return good.select(*[F.col(f"`{c}`") for c in good.columns if c != out],
                       *[F.try_variant_get(out, name(f.name), f.dataType.simpleString())
                         .alias(f.name) for f in schema.fields])
