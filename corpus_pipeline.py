"""A training-data pipeline: toxicity, near duplicates, personal data, mixing, BPE.

``STAGES`` lists (name, function) in order; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which ``run`` writes as Parquet in the shared
checkpoint folder and reads again as the next stage's ``docs``.  All stages
but the last return the columns of ``documents``.  Every stage accepts nulls
in any column, empty and very long texts, repeated rows, empty tables and
extra columns, as its operator defines them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestack.llm import bpe, mixing, ngram_join, pii, toxicity
from candlestack.llm.common import materialize
from candlestack.llm.queries import vocabulary_file
from candlestack.sources.tables import read_table


#: Number of a row within the stage that drops near duplicates.
ROW = "_row_of_stage"
#: Bits of the filter that tells which rows take part in a join with their
#: texts; a Spark bitmap holds 2 ** 15 of them.
FILTER_BITS = 26


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _may_be_in(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose ROW stands in ``wanted`` and a few
    others, and the rest.  Rows are told apart by a filter of fixed size,
    whatever the number of rows, so neither part is shuffled."""
    bucket, bits = f"{ROW}_bucket", f"{ROW}_bits"
    place = F.pmod(F.xxhash64(ROW), F.lit(1 << FILTER_BITS))
    inner = place.bitwiseAND((1 << 15) - 1)
    maps = (wanted.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias(bucket))
            .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND((1 << 15) - 1)).alias(bits)))
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(inner, 3) + 1).cast("int"), F.lit(1))),
                  16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, inner.bitwiseAND(7).cast("int")) == 1, F.lit(False))
    marked = rows.join(F.broadcast(maps), F.shiftright(place, 15) == F.col(bucket), "left")
    return tuple(marked.where(of).select(*_columns(rows)) for of in (hit, ~hit))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below its threshold.

    The model learns from a bounded sample of the labelled documents; every
    row is judged by its own text, in one pass without a shuffle."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.train(docs, labels)
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id
    (a null last), and of several rows with that doc_id the one whose text
    sorts first.  Rows without words are in no group and stay, as does every
    row that links with no other, whatever rows share its doc_id."""
    # rows are told apart by a number that is written once, not by their doc_id
    rows = materialize(docs.select(*_columns(docs), F.monotonically_increasing_id().alias(ROW)),
                       "rows")
    found = (ngram_join.link_classes(rows.select(F.col(ROW).alias("doc_id"), "text"))
             .where("component is not null").select(F.col("doc_id").alias(ROW), "component"))
    # only groups of two rows or more lose any
    groups = found.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = materialize(found.join(groups, "component").select(ROW, "component")
                        .join(rows.select(ROW, "doc_id"), ROW), "groups")
    least = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")).alias("least"))
    first = (found.join(least, "component")
             .where(F.col("doc_id").eqNullSafe(F.col("least.doc_id"))).select(ROW, "component"))
    order = F.struct("text", F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{i}")
                                        for i, c in enumerate(docs.columns)]), ROW)
    # texts are compared, and moved, only where rows share the smallest doc_id
    first = materialize(first, "first")
    held = first.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min(ROW).alias(ROW))
    tied = materialize(first.join(held.where("n > 1").select("component"), "component"), "tied")
    kept = (_may_be_in(rows, tied)[0].select(ROW, order.alias("order")).join(tied, ROW)
            .groupBy("component").agg(F.min_by(ROW, "order").alias(ROW)))
    kept = held.where("n = 1").select(ROW).unionAll(kept.select(ROW))
    losers = materialize(found.join(kept, ROW, "left_anti").select(ROW), "losers")
    # only rows that may be lost meet the losers
    some, rest = _may_be_in(rows, losers)
    return (rest.unionAll(some.join(losers, ROW, "left_anti").select(*_columns(rest)))
            .select(*_columns(docs)))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what discloses it replaced in the texts."""
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: rows repeat as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of the mix."""
    return bpe.round_trip_digests(docs, vocabulary_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: Learned scores, seeded blocks and BPE cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
