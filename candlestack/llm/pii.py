"""Personal data: base patterns, and terms that give away what they protect (native).

Base spans are found by four patterns (e-mail, IP address, card number,
telephone).  Each distinct value is a protected entity.  Corpus co-occurrence
then estimates how strongly a term near an entity reveals it: over documents,

    IC(e)     = log2(N / n(e))               information the entity carries
    PMI(e, t) = log2(N n(e, t) / (n(e) n(t)))   information the term gives about it

and PMI / IC is the share of the entity that the term discloses.  Terms whose
share reaches ``remove_at`` are removed, those that reach ``generalise_at``
are generalised (replaced by their shape), wherever they stand near a span of
that entity.  All four numbers count distinct texts, of the whole corpus, and
n(e, t) must reach ``min_support``.

Only DataFrame and SQL functions.  Matches and their offsets come from
splitting the text at the pattern; the patterns are possessive and anchored
by look-behind, so they take linear time and no stack on any text, and find
exactly the leftmost non-overlapping matches of the plain patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestack.llm.common import materialize, no_null_text, text_key

#: Kinds in the order in which they are listed where spans start together.
KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("removed", "generalised")

#: Characters around a span in which a term counts as near it.
CONTEXT = 80
MIN_SUPPORT = 3
REMOVE_AT = 0.9
GENERALISE_AT = 0.8

_LOCAL = "[A-Za-z0-9._%+-]"
#: The plain pattern of each kind, made possessive.  E-mail: a match starts
#: where a run of local characters starts or where the last match ended.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}",
    # whole runs of 14 to 19 digits; shorter and longer runs fail as a whole
    "card": r"[0-9](?<![0-9][\x20-]?[0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TERM = r"[\p{L}\p{N}]{3,}"

SPAN = "struct<begin:int,kind_order:int,end:int,kind:string,value:string>"


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled; the sum ends in 0."""
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 0, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]+", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _located(matches: Column, gaps: Column, at: Column) -> Column:
    """Offsets of matches from the pieces between them: the i-th match starts
    after i + 1 gaps and i matches."""
    state = F.aggregate(
        matches,
        F.struct(at.cast("int").alias("pos"), F.lit(0).alias("i"),
                 F.array().cast("array<struct<begin:int,end:int,value:string>>").alias("out")),
        lambda s, m: F.struct(
            (s["pos"] + F.length(F.get(gaps, s["i"])) + F.length(m)).alias("pos"),
            (s["i"] + 1).alias("i"),
            F.concat(s["out"], F.array(F.struct(
                (s["pos"] + F.length(F.get(gaps, s["i"]))).alias("begin"),
                (s["pos"] + F.length(F.get(gaps, s["i"])) + F.length(m)).alias("end"),
                m.alias("value")))).alias("out")))
    return state["out"]


def base_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans``: array of struct(begin, kind_order, end, kind, value) of
    the base kinds, by begin, then kind as listed.  A null text has none."""
    t = no_null_text(text)
    hint = {"email": F.instr(t, "@") > 0, "phone": F.instr(t, "+") > 0}
    none = F.array().cast("array<string>")
    df = df.withColumns({f"_m_{k}": F.when(hint.get(k, F.lit(True)),
                                           F.regexp_extract_all(t, F.lit(PATTERNS[k]), F.lit(0)))
                         .otherwise(none) for k in KINDS})

    def of_kind(order: int, kind: str) -> Column:
        m = F.col(f"_m_{kind}")
        placed = F.when(F.size(m) > 0, _located(m, F.split(t, PATTERNS[kind], -1), F.lit(0)))
        good = F.filter(placed, lambda s: _valid(kind, s["value"]))
        return F.coalesce(F.transform(good, lambda s: F.struct(
            s["begin"].alias("begin"), F.lit(order).alias("kind_order"), s["end"].alias("end"),
            F.lit(kind).alias("kind"), s["value"].alias("value"))),
            F.array().cast(f"array<{SPAN}>"))

    per_kind = [of_kind(i, k) for i, k in enumerate(KINDS)]
    return (df.withColumn("spans", F.array_sort(F.concat(*per_kind)))
            .drop(*[f"_m_{k}" for k in KINDS]))


def entity(span: Column) -> Column:
    """The protected value: kind and e-mail in lower case or digits alone."""
    return F.concat(span["kind"], F.lit(":"), F.when(
        span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(
        F.lower(span["value"])))


def _terms_in(text: Column, at: Column) -> Column:
    return _located(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)),
                    F.split(text, TERM, -1), at)


def near_terms(df: DataFrame, context: int) -> Column:
    """For each span, the terms that lie whole within ``context`` characters
    before or after it and touch no base span: array of struct(entity, term,
    begin, end)."""
    t, spans = no_null_text("text"), F.col("spans")

    def around(s: Column) -> Column:
        low = F.greatest(s["begin"] - context, F.lit(0))
        before = F.substring(t, low + 1, s["begin"] - low)
        after = F.substring(t, s["end"] + 1, F.lit(context))
        found = F.concat(_terms_in(before, low), _terms_in(after, s["end"]))
        # a term cut by the window is not whole; one touching the text's ends is
        top = s["end"] + context
        whole = F.filter(found, lambda x: ((x["begin"] > low) | (low == 0))
                         & ((x["end"] < top) | (x["end"] >= F.length(t)))
                         & (x["begin"] != s["end"]) & (x["end"] != s["begin"])
                         & ~F.exists(spans, lambda o: (x["begin"] < o["end"])
                                     & (x["end"] > o["begin"])))
        return F.transform(whole, lambda x: F.struct(
            entity(s).alias("entity"), F.lower(x["value"]).alias("term"),
            x["begin"].alias("begin"), x["end"].alias("end")))

    return F.when(F.size(spans) > 0, F.flatten(F.transform(spans, around)))


def disclosure(texts: DataFrame, marked: DataFrame, min_support: int,
               generalise_at: float) -> DataFrame:
    """(entity, term, share) of the pairs at or above ``generalise_at``.

    ``marked``: (doc_id, text_key, spans, near); ``texts``: (doc_id, text), the
    corpus, of which each distinct text counts once."""
    near = (marked.where("near is not null").select("text_key", F.explode("near").alias("x"))
            .select("text_key", "x.entity", "x.term").distinct())
    pairs = (near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))
             .where(F.col("n_et") >= min_support))
    entities = (marked.where(F.size("spans") > 0)
                .select("text_key", F.explode(F.transform("spans", entity)).alias("entity"))
                .distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")))
    once = (texts.select("text", text_key(F.col("text")).alias("text_key"))
            .dropDuplicates(["text_key"]))
    words = once.select(F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all(no_null_text("text"), F.lit(TERM), F.lit(0)), F.lower)))
        .alias("term"))
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    total = F.lit(marked.select("text_key").distinct().count())
    share = (F.log2(total * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
             / F.log2(total / F.col("n_e")))
    return (pairs.join(entities, "entity").join(counts, "term")
            .where(total > F.col("n_e"))
            .select("entity", "term", share.alias("share"))
            .where(F.col("share") >= generalise_at))


def find_personal_data(docs: DataFrame, context: int = CONTEXT, min_support: int = MIN_SUPPORT,
                       remove_at: float = REMOVE_AT,
                       generalise_at: float = GENERALISE_AT) -> DataFrame:
    """(doc_id, text_key, base, terms): for every distinct (doc_id, text) of
    ``docs`` its base spans and the terms to remove or generalise, each an
    array of struct(begin, kind_order, end, kind, value), ascending; a term
    that several entities flag has the stronger decision.

    A null text counts as empty and has no spans; repeated rows count once per
    distinct text where co-occurrence is estimated; a null doc_id is a
    document like any other.  An empty table gives an empty table.  Columns
    other than doc_id and text are ignored."""
    texts = docs.select("doc_id", no_null_text("text").alias("text"))
    marked = base_spans(texts.withColumn("text_key", text_key(F.col("text"))))
    marked = materialize(marked.withColumn("near", near_terms(marked, context))
                         .select("doc_id", "text_key", "spans", "near"), "marked")
    shares = disclosure(texts, marked, min_support, generalise_at)
    mentions = (marked.where("near is not null")
                .select("doc_id", "text_key", F.explode("near").alias("x"))
                .select("doc_id", "text_key", "x.*"))
    kind = F.when(F.col("share") >= remove_at, F.lit(0)).otherwise(F.lit(1))
    flagged = (mentions.join(shares, ["entity", "term"])
               .groupBy("doc_id", "text_key", "begin", "end", "term").agg(F.min(kind).alias("k"))
               .select("doc_id", "text_key", F.struct(
                   F.col("begin"), (F.col("k") + len(KINDS)).cast("int").alias("kind_order"),
                   F.col("end"), F.when(F.col("k") == 0, TERM_KINDS[0]).otherwise(TERM_KINDS[1])
                   .alias("kind"), F.col("term").alias("value")).alias("s"))
               .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
               .agg(F.array_sort(F.collect_list("s")).alias("terms")))
    once = marked.select("doc_id", "text_key", F.col("spans").alias("base"))
    return (once.join(flagged, F.col("doc_id").eqNullSafe(F.col("_id"))
                      & (F.col("text_key") == F.col("_key")), "left")
            .select("doc_id", "text_key", "base",
                    F.coalesce("terms", F.array().cast(f"array<{SPAN}>")).alias("terms")))


def span_list(spans: Column) -> Column:
    """kind:begin:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat(
        s["kind"], F.lit(":"), s["begin"].cast("string"), F.lit(":"), s["end"].cast("string"))),
        ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced: base spans by their kind in square
    brackets, removed terms by nothing, generalised terms by a shape (all
    digits: [NUMBER], else [WORD]).  Spans that overlap are replaced as one by
    the mark of the first."""
    def mark(s: Column) -> Column:
        return (F.when(s["kind"] == "removed", "")
                .when(s["kind"] == "generalised",
                      F.when(s["value"].rlike(r"\A\p{N}+\z"), "[NUMBER]").otherwise("[WORD]"))
                .otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))

    done = F.aggregate(
        spans, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.when(s["begin"] >= acc["pos"], F.concat(
                acc["out"], F.substring(text, acc["pos"] + 1, s["begin"] - acc["pos"]),
                mark(s))).otherwise(acc["out"]).alias("out")))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(done["out"], F.substring(text, done["pos"] + 1, F.length(text))))


def sanitise(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with its texts redacted: same rows, same columns (a null text
    stays null)."""
    found = find_personal_data(docs, **params).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
        F.array_sort(F.concat("base", "terms")).alias("_spans"))
    found = found.where(F.size("_spans") > 0).dropDuplicates(["_id", "_key"])
    # the user's columns go in one struct, so none of their names can clash
    packed = F.struct(F.lit(0).alias("none"), *[
        F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"])
    keyed = docs.select(packed.alias("_row"), "doc_id", "text",
                        text_key(no_null_text("text")).alias("_text_key"))
    out = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.col("_text_key") == F.col("_key")), "left")
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(
        redact(F.col("text"), F.col("_spans")))
    return out.select(*[(text if c == "text" else F.col("_row")[f"c{i}"]).alias(c)
                        for i, c in enumerate(docs.columns)])
