"""Registered queries of this package: thin digests of the operators' results,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestack.llm import (ann, bpe, embedding_dedup, licenses, line_dedup, mixing, ngram_join,
                             pii, resampling, spelling, suffix_dedup, token_files, toxicity)
from candlestack.llm.common import scratch_path
from candlestack.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary_file(name: str) -> str:
    """Path of a public vocabulary file on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@register
def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@register
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


@register
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@register
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"))
    m = F.col("matches")
    return found.select(
        "doc_id", F.size(m).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["license"]))),
                     ",").alias("licenses"),
        F.array_max(F.transform(m, lambda x: x["score"])).alias("best_score"),
        F.array_join(F.transform(m, lambda x: F.concat(
            x["license"], F.lit(":"), x["begin"].cast("string"), F.lit(":"),
            x["end"].cast("string"))), ",").alias("spans"))


@register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        toxicity.rejected(F.col("score")).cast("int").alias("predicted"))


@register
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"),
                                  vocabulary_file("word_bpe_49k.json"), out)
    return token_files.read_token_files(spark, out)


@register
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find_personal_data(docs)
    base = F.col("base")

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.span_list(base), 256).alias("base_sha256"),
        pii.span_list(F.array_sort(F.concat("base", "terms"))).alias("spans"),
        F.size("terms").cast("long").alias("n_terms"))


@register
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(read_table(spark, sf_dir, "documents"))


@register
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"),
                                  vocabulary_file("byte_bpe_50k.json"))


@register
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed",
        F.array_join(F.transform("removed", lambda r: F.concat(
            r["begin"].cast("string"), F.lit(":"), r["end"].cast("string"))), ",")
        .alias("removed"), F.sha2("text", 256).alias("kept_sha256"))


@register
def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_passages(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_removed", F.array_join(F.transform("removed", lambda r: F.concat(
            r["begin"].cast("string"), F.lit(":"), r["end"].cast("string"))), ",")
        .alias("removed"), F.sha2("text", 256).alias("kept_sha256"))


@register
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = F.transform("removed", lambda r: r["end"] - r["begin"])
    return suffix_dedup.dedup_substrings(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes",
        F.aggregate(runs, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@register
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


@register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


ORACLE: dict[str, str] = {
    # a line's words, ASCII lower case, single spaces; the first of each kind stays
    "op10_line_dedup": r"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
lines as (
    select doc_id, text, unnest(string_split(text, chr(10))) as line,
           unnest(range(1, len(string_split(text, chr(10))) + 1)) as nr
    from docs),
placed as (
    select *, coalesce(sum(length(line) + 1) over (
               partition by doc_id, text order by nr
               rows between unbounded preceding and 1 preceding), 0) as begin_at,
           list_filter(regexp_split_to_array(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
    from lines),
ranked as (
    select *, len(words) >= 5 and row_number() over (
               partition by array_to_string(words, ' ')
               order by doc_id nulls last, begin_at) > 1 as gone
    from placed)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
       coalesce(string_agg(cast(begin_at as bigint) || ':'
                           || cast(begin_at + length(line) as bigint), ','
                           order by nr) filter (gone), '') as removed,
       sha256(coalesce(string_agg(line, chr(10) order by nr) filter (not gone), ''))
           as kept_sha256
from ranked group by doc_id, text
""",
}
