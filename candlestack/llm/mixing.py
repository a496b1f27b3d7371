"""Mixing sources to target weights by Sainte-Lague apportionment (native).

Every source gets a target share of all words (weights, with a limit on how
often a source may be repeated).  The targets are turned into integer quotas
of equal word blocks by highest quotients: first per source, then per shard
of the source.  A shard is a bounded, seeded hash class of the source's
documents, laid out as one stream in seeded order and cut into blocks; its
quota is whole passes over the stream plus a run of consecutive blocks that
starts at a seeded block.  Documents are in random order in the stream, so
the run is a random choice of documents, and all but two documents of a shard
are taken whole.

Only DataFrame functions: one scan of the texts (word counts), one grouped
aggregate per level, one window per shard.  Windows without a key run over
one row per source only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlestack.llm.common import WORD, materialize, word_count

#: Words in a block at most, blocks a source has at least, documents aimed at in a
#: shard, passes over a source at most.
BLOCK_WORDS = 16
SOURCE_BLOCKS = 16
SHARD_DOCS = 2_000
MAX_PASSES = 3
SEED = 17


def source_targets(sources: DataFrame, weights: Sequence[float] = (1, 2, 3),
                   max_passes: int = MAX_PASSES) -> DataFrame:
    """``sources`` (source, source_size) plus ``rank`` (1 from the smallest
    code point, null last), ``weight`` (``weights`` repeating by rank) and
    ``target``: the shares by weight of all words, none above ``max_passes``
    times its source, the excess shared again by weight.

    With the sources in order of limit / weight, those at their limit come
    first; a source is among them when its share of what the earlier ones
    leave exceeds its limit."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (sources
              .withColumn("rank", F.row_number().over(
                  Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
              .withColumn("weight", F.element_at(
                  cycle, (((F.col("rank") - 1) % len(weights)) + 1).cast("int")))
              .withColumn("limit", F.col("source_size") * F.lit(max_passes)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    staged = ranked.withColumn("level", left / F.sum("weight").over(after))
    staged = staged.withColumn("full", F.col("level") * F.col("weight") > F.col("limit"))
    # the first source that is not full holds the level of all later ones
    common = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(whole)
    return (staged.withColumn("common", common)
            .withColumn("target", F.when(F.col("full"), F.col("limit").cast("double"))
                        .otherwise(F.col("common") * F.col("weight")))
            .select("source", "source_size", "n_docs", "rank", "weight", "target"))


def apportion(votes: DataFrame, keys: Sequence[str], seats: Column, tie: Column) -> DataFrame:
    """Add ``quota``: ``seats`` (same in all rows of a group of ``keys``)
    allotted to the rows by Sainte-Lague on column ``votes``.

    The k-th seat of a row has the quotient votes / (2k - 1), and the highest
    quotients win.  With n rows, S seats and d = votes per seat, rounding at
    divisor d/(1 + n/2S) gives at least S seats and at d/(1 - n/2S) at most S,
    so only the seats between the two roundings (about 2n) are ranked."""
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    v = (votes.withColumn("_seats", seats.cast("double"))
         .withColumn("_n", F.count(F.lit(1)).over(group))
         .withColumn("_per_seat", F.try_divide(F.sum("votes").over(group), F.col("_seats")))
         .withColumn("_tie", tie))
    share = F.coalesce(F.try_divide(F.col("votes"), F.col("_per_seat")), F.lit(0.0))
    slack = F.coalesce(F.try_divide(F.col("_n"), 2 * F.col("_seats")), F.lit(0.0))
    low = F.floor(share * F.greatest(1 - slack, F.lit(0.0)) + 0.5 - 1e-6)
    high = F.floor(share * (1 + slack) + 0.5 + 1e-6)
    v = (v.withColumn("_low", F.greatest(low, F.lit(0)).cast("long"))
         .withColumn("_high", F.when(F.col("votes") > 0, high).otherwise(0).cast("long")))
    v = v.withColumn("_open", F.col("_seats") - F.sum("_low").over(group))
    ids = [*keys, "_tie"]
    contested = (v.where("_high > _low")
                 .select(*ids, "_open", "votes",
                         F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_k"))
                 .withColumn("_quotient", F.col("votes") / (2 * F.col("_k") - 1)))
    best = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(
        F.col("_quotient").desc(), "_tie", "_k")
    won = (contested.withColumn("_place", F.row_number().over(best))
           .where(F.col("_place") <= F.col("_open"))
           .groupBy(*ids).agg(F.count(F.lit(1)).alias("_won")))
    return (v.join(won, ids, "left")
            .withColumn("quota", F.col("_low") + F.coalesce(F.col("_won"), F.lit(0)))
            .drop("_seats", "_n", "_per_seat", "_low", "_high", "_open", "_won", "_tie"))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), seed: int = SEED,
        block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS,
        max_passes: int = MAX_PASSES, keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source,
    size, source_size, target, taken, passes, from_word, to_word, from_word2,
    to_word2 and the columns ``keep``.

    ``taken`` = ``passes`` * size + the words [from_word, to_word) and
    [from_word2, to_word2) of the document that the run of blocks adds (the
    second piece is empty but for a document in which the run both ends and
    starts).  A null text has size 0, as has an empty one; size 0 takes 0.  A
    null source is a source of its own.  Repeated rows are documents of their
    own and are taken like any other.  All blocks have ``block_words`` words, or
    fewer where the smallest source would have less than SOURCE_BLOCKS of them, so a
    source of any size comes within a block of its target; rows alike in doc_id and size may swap
    their places in the stream, which leaves the result the same.  An empty
    table gives an empty table.  Columns of ``docs`` other than these four
    and ``keep`` are ignored."""
    sized = materialize(docs.select("doc_id", "source", *keep,
                                    word_count(F.col("text")).alias("size")), "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                          F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(sources, weights, max_passes)
    every = Window.partitionBy(F.lit(0))  # one row per source
    least = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(every)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(least / SOURCE_BLOCKS)))
    quotas = apportion(targets.withColumn("votes", F.col("target"))
                       .withColumn("_total", F.sum("source_size").over(every))
                       .withColumn("block", block.cast("long")), [],
                       F.round(F.col("_total") / F.col("block")), F.col("rank"))
    quotas = materialize(quotas.select("source", "rank", "source_size", "n_docs", "target",
                                       "block", F.col("quota").alias("source_quota")), "quotas")

    placed = (sized.alias("d")
              .join(quotas.select(F.col("source").alias("_s"), "rank", "source_size", "target",
                                  "n_docs"),
                    F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("_order", F.xxhash64("doc_id", "size", F.lit(seed)))
              .withColumn("shard", F.pmod(F.xxhash64("_order", F.lit(seed + 1)),
                                          F.ceil(F.col("n_docs") / shard_docs)).cast("long")))
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("votes"))
    shards = (shards.join(quotas.select("rank", "source_quota", "block"), "rank")
              .withColumn("words", F.col("votes"))
              .withColumn("votes", F.col("votes").cast("double")))
    # the last block of a shard may be short: its run goes on until the quota's words are taken
    shards = (apportion(shards, ["rank"], F.col("source_quota"), F.col("shard"))
              .withColumn("quota", F.least(F.col("quota") * F.col("block"),
                                           max_passes * F.col("words")))
              .withColumn("passes", F.coalesce(F.try_divide(F.col("quota"), F.col("words")),
                                               F.lit(0.0)).cast("long"))
              .withColumn("run", F.col("quota") - F.col("passes") * F.col("words"))
              .withColumn("start", F.when(F.col("words") > 0, F.col("block") * F.pmod(
                  F.xxhash64("rank", "shard", F.lit(seed + 2)),
                  F.ceil(F.col("words") / F.col("block")))).otherwise(0))
              .select("rank", "shard", "words", "passes", "run", "start"))

    stream = Window.partitionBy("rank", "shard").orderBy("_order", "doc_id", "size")
    laid = (placed.withColumn("_end", F.sum("size").over(
                stream.rowsBetween(Window.unboundedPreceding, 0)))
            .join(shards, ["rank", "shard"])
            .withColumn("_begin", F.col("_end") - F.col("size"))
            .withColumn("_a", F.col("start"))
            .withColumn("_b", F.col("start") + F.col("run"))
            .withColumn("_round", F.col("words")))

    def piece(lo: Column, hi: Column) -> tuple[Column, Column]:
        a = F.least(F.greatest(lo - F.col("_begin"), F.lit(0)), F.col("size"))
        b = F.least(F.greatest(hi - F.col("_begin"), F.lit(0)), F.col("size"))
        return a.cast("long"), b.cast("long")

    a1, b1 = piece(F.col("_a"), F.col("_b"))
    a2, b2 = piece(F.col("_a") - F.col("_round"), F.col("_b") - F.col("_round"))
    pieces = laid.withColumns({"from_word": a1, "to_word": b1, "from_word2": a2, "to_word2": b2})
    taken = (F.col("passes") * F.col("size") + F.col("to_word") - F.col("from_word")
             + F.col("to_word2") - F.col("from_word2"))
    return pieces.select("doc_id", "source", *keep, "size", "source_size", "target",
                         taken.cast("long").alias("taken"), "passes", "from_word", "to_word",
                         "from_word2", "to_word2")


def words_between(text: Column, a: Column, b: Column) -> Column:
    """The words [a, b) of a text with the white space between them as it is."""
    skip = r"[\x20\x09-\x0D]*+"
    head = F.concat(F.lit(rf"\A(?:{skip}{WORD}+)" + "{"), a.cast("string"), F.lit("}+" + skip))
    body = F.concat(F.lit(rf"\A(?:{skip}{WORD}+)" + "{"), (b - a).cast("string"), F.lit("}+"))
    rest = F.regexp_replace(text, head, F.lit(""))
    return F.coalesce(F.regexp_substr(rest, body), F.lit(""))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, one row for each pass over a
    document and one for each piece that the run of blocks takes of it (whole
    for all but two documents of a shard).  Documents without words, which no
    word mix can take, stay as they are."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    packed = docs.select("doc_id", "text", "source", F.col("text").alias("_text"), F.struct(
        F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
        .alias("_rest"))
    got = mix(packed, keep=("_text", "_rest"), **params)
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b")),
                           F.when(F.col("size") == 0, 1).otherwise(F.col("passes")).cast("int"))
    parts = F.filter(F.array(F.struct(F.col("from_word").alias("a"), F.col("to_word").alias("b")),
                             F.struct(F.col("from_word2").alias("a"),
                                      F.col("to_word2").alias("b"))),
                     lambda p: p["b"] > p["a"])
    rows = got.withColumn("_take", F.explode(F.concat(whole, parts)))
    full = (F.col("_take.a") == 0) & (F.col("_take.b") == F.col("size"))
    text = F.when(full, F.col("_text")).otherwise(
        words_between(F.col("_text"), F.col("_take.a"), F.col("_take.b")))
    restored = {c: F.col("_rest")[f"c{i}"] for i, c in enumerate(rest)}
    restored |= {"doc_id": F.col("doc_id"), "text": text, "source": F.col("source")}
    return rows.select(*[restored[c].alias(c) for c in docs.columns])
