"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver tables (or data Spark derives from them) in full.
Doubles are rounded to 4 digits at this presentation edge only, so results
compare exactly with the DuckDB oracle (``plans.oracle``); the operators
themselves return full precision.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlestack.functions.dates import epoch_millis_text, month_label, quarter_label
from candlestack.functions.numeric import round_doubles
from candlestack.operators import bars as B
from candlestack.operators import logs as L
from candlestack.operators import paging as G
from candlestack.operators import payloads as PL
from candlestack.operators import periods as P
from candlestack.operators import rolling as R
from candlestack.operators import sketches as SK
from candlestack.operators import stats as S
from candlestack.schemas import BAR, STOCK_DOC, YEARLY
from candlestack.session import materialize, scratch_path
from candlestack.sinks import documents as D
from candlestack.sinks import landing as LD
from candlestack.sinks import bulk as BK
from candlestack.sinks import points as PT
from candlestack.sinks import sets as ST
from candlestack.sinks import upsert as U
from candlestack.sources import csv as CSV
from candlestack.sources import manifest as MF
from candlestack.sources.tables import TABLES, read_table, table_path
from candlestack.streaming import counts as SC
from candlestack.streaming import events as SE
from candlestack.streaming import heartbeats as HB
from candlestack.streaming import increments as SI

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars derived from ``lineitem`` ticks.

    The tick order is (time of day, order key, line number, part key,
    supplier key), unique within a bar on these tables; packed into one
    number it lets the aggregate over the ticks run hash-based.
    """
    return bars_of(read_table(spark, sf_dir, "lineitem"))


def bars_of(ticks: DataFrame, **kw) -> DataFrame:
    """Bars of ``ticks`` with the packed tick order.  No job runs when the
    query is built."""
    return B.bars_from_ticks(ticks, tiebreak=LINEITEM_ORDER, bits=B.LINEITEM_BITS, **kw)


LINEITEM_ORDER = B.LINEITEM_TIEBREAK[:-1]


@register("bars_daily")
def q_bars_daily(spark, sf_dir):
    return bars(spark, sf_dir)


@register("bars_daily_struct_order")
def q_bars_daily_struct_order(spark, sf_dir):
    # The fallback tick order (struct tie-break, sort-based aggregate) gives
    # the same bars as the packed key.
    return B.bars_from_ticks(read_table(spark, sf_dir, "lineitem"))


@register("monthly_stats")
def q_monthly_stats(spark, sf_dir):
    return round_doubles(P.monthly_stats(bars(spark, sf_dir), digits=4))


@register("quarterly_stats")
def q_quarterly_stats(spark, sf_dir):
    return round_doubles(P.quarterly_stats(bars(spark, sf_dir), digits=4))


@register("yearly_stats")
def q_yearly_stats(spark, sf_dir):
    return round_doubles(P.yearly_stats(bars(spark, sf_dir), digits=4))


@register("yoy_growth")
def q_yoy_growth(spark, sf_dir):
    return round_doubles(P.yoy_growth(P.period_stats(bars(spark, sf_dir), "yearly", digits=4,
                                                    keep_raw=True)))


@register("period_stats_long")
def q_period_stats_long(spark, sf_dir):
    return round_doubles(P.period_stats_long(bars(spark, sf_dir), digits=4))


@register("period_stats_from_landed")
def q_period_stats_from_landed(spark, sf_dir):
    # Bars landed once (by year), then analysed from the landed table: the
    # tick aggregation is not repeated for each analysis.
    path = LD.land(bars(spark, sf_dir), scratch_path(spark, "landed-bars"))
    landed = spark.read.parquet(path).drop("year")
    return round_doubles(P.period_stats_long(landed, digits=4))


@register("scalar_date_parts")
def q_scalar_date_parts(spark, sf_dir):
    # Date functions of the survey's scalar list: parse a date from text,
    # year, quarter, month label, quarter label (per distinct ship day).
    days = (read_table(spark, sf_dir, "lineitem")
            .select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_text")).distinct())
    d = F.to_date("date_text", "yyyy-MM-dd")
    return days.select("date_text", d.alias("Date"), F.year(d).alias("Year"),
                       F.quarter(d).alias("Q"), month_label(d).alias("Month"),
                       quarter_label(d).alias("Quarter"))


@register("period_start")
def q_period_start(spark, sf_dir):
    return (P.period_stats_long(bars(spark, sf_dir))
            .select("symbol", "period_type", "period", "period_start"))


@register("monthly_analysis")
def q_monthly_analysis(spark, sf_dir):
    return P.monthly_analysis(bars(spark, sf_dir))


# --- rolling analytics (W15, W25-W27, W37) -------------------------------


@register("daily_return")
def q_daily_return(spark, sf_dir):
    return round_doubles(R.daily_return(bars(spark, sf_dir), bounded=True))


@register("moving_avg_5")
def q_moving_avg_5(spark, sf_dir):
    return round_doubles(R.moving_average(bars(spark, sf_dir), 5, bounded=True))


@register("moving_avg_20")
def q_moving_avg_20(spark, sf_dir):
    return round_doubles(R.moving_average(bars(spark, sf_dir), 20, bounded=True))


@register("volatility_20")
def q_volatility_20(spark, sf_dir):
    return round_doubles(R.volatility(bars(spark, sf_dir), 20, bounded=True))


def recent_bars(spark: SparkSession, sf_dir: str, days: int = 30):
    """Bars of the last ``days`` calendar days up to the newest tick date.

    The as-of date is one scalar (a global max over one column); with it the
    date range becomes literal bounds on the raw timestamp, pushed into the
    Parquet scan, so only the recent ticks are read and aggregated instead
    of bars over the whole history being built and then filtered.
    """
    li = read_table(spark, sf_dir, "lineitem")
    as_of = li.agg(F.max(F.to_date("l_shipdate"))).first()[0]
    start = as_of - dt.timedelta(days=days)
    return bars_of(li, start=start, end=as_of), as_of


@register("analyze_last_n_days")
def q_analyze_last_n_days(spark, sf_dir):
    recent, as_of = recent_bars(spark, sf_dir, 30)
    return round_doubles(R.analyze_last_n_days(recent, days=30, as_of=as_of))


# --- statistics (W19, W21, W22, W38, W39) ---------------------------------

@register("price_movement")
def q_price_movement(spark, sf_dir):
    return S.price_movement(bars(spark, sf_dir))


@register("summary_stats")
def q_summary_stats(spark, sf_dir):
    return round_doubles(S.summary_stats(bars(spark, sf_dir), digits=4))


@register("describe_exact")
def q_describe_exact(spark, sf_dir):
    return round_doubles(S.describe_exact(bars(spark, sf_dir), digits=4, bounded=True))


@register("describe_last_n_days")
def q_describe_last_n_days(spark, sf_dir):
    recent, as_of = recent_bars(spark, sf_dir, 30)
    # two aggregates read the slice: write the (small) slice once
    return round_doubles(S.describe_exact(materialize(R.last_n_days(recent, 30, as_of)),
                                          digits=4, bounded=True))


@register("headline_stats")
def q_headline_stats(spark, sf_dir):
    recent, as_of = recent_bars(spark, sf_dir, 30)
    return round_doubles(S.headline_stats(R.analyze_last_n_days(recent, days=30, as_of=as_of)))


@register("row_count")
def q_row_count(spark, sf_dir):
    return S.row_count(bars(spark, sf_dir))


# --- ranges, top-k, paging (W6, W20, W23, W28) ----------------------------

@register("date_range")
def q_date_range(spark, sf_dir):
    return bars_of(read_table(spark, sf_dir, "lineitem"), start="1998-01-01", end="1998-12-31")


@register("date_range_landed")
def q_date_range_landed(spark, sf_dir):
    # Range read of bars landed by year: folders of other years are pruned.
    path = LD.land(bars(spark, sf_dir), scratch_path(spark, "landed-range"))
    return G.date_range(spark.read.parquet(path), "1998-01-01", "1998-12-31")


@register("top_k_latest")
def q_top_k_latest(spark, sf_dir):
    return G.top_k_latest(bars(spark, sf_dir), k=100)


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written as keyed documents and read back from the document files."""
    path = scratch_path(spark, "bar-docs")
    D.write_documents(D.bar_documents(B.derived_columns(bars(spark, sf_dir))), path)
    docs = spark.read.schema("_id string, _source string, _index string").json(path)
    return docs.select(F.from_json("_source", STOCK_DOC).alias("d")).select("d.*")


@register("scan_documents")
def q_scan_documents(spark, sf_dir):
    # The whole index, newest first: no request limit.
    return landed_documents(spark, sf_dir).orderBy(F.col("Date").desc(), "symbol")


@register("top_k_latest_documents")
def q_top_k_latest_documents(spark, sf_dir):
    return G.top_k_latest(landed_documents(spark, sf_dir), k=100)


def stored_bar_documents(spark: SparkSession, sf_dir: str) -> str:
    return D.store_documents(B.derived_columns(bars(spark, sf_dir)),
                             scratch_path(spark, "doc-store"), ["symbol", "Date"])


@register("documents_range")
def q_documents_range(spark, sf_dir):
    # Stored documents of one year: other years' folders are not listed, other
    # dates' row groups are not read.
    path = stored_bar_documents(spark, sf_dir)
    return D.stored_documents(spark, path, "1998-03-01", "1998-10-31")


@register("documents_newest_first")
def q_documents_newest_first(spark, sf_dir):
    path = stored_bar_documents(spark, sf_dir)
    return D.stored_documents(spark, path).orderBy(F.col("Date").desc(), "symbol")


@register("documents_by_id")
def q_documents_by_id(spark, sf_dir):
    path = stored_bar_documents(spark, sf_dir)
    return D.documents_by_id(spark, path, ["A|1998-03-02", "N|1998-03-02", "R|1996-07-01",
                                           "no such id"])


@register("page")
def q_page(spark, sf_dir):
    return G.page(bars(spark, sf_dir), n=2, k=5)


@register("page_deep")
def q_page_deep(spark, sf_dir):
    return G.page(bars(spark, sf_dir), n=1_000, k=5)


@register("total_pages")
def q_total_pages(spark, sf_dir):
    return G.total_pages(bars(spark, sf_dir), 5)


@register("page_stats")
def q_page_stats(spark, sf_dir):
    return G.page_stats(bars(spark, sf_dir), k=5, bounded=True)


# --- logs, metrics, availability, retention (R1-R5, batch) ----------------

@register("word_count")
def q_word_count(spark, sf_dir):
    return L.word_count(read_table(spark, sf_dir, "documents"))


@register("log_ingest")
def q_log_ingest(spark, sf_dir):
    return L.parse_events(read_table(spark, sf_dir, "events"))


@register("metric_window")
def q_metric_window(spark, sf_dir):
    return round_doubles(L.metric_window(read_table(spark, sf_dir, "events"), "10 seconds"))


@register("uptime_gaps")
def q_uptime_gaps(spark, sf_dir):
    return round_doubles(L.uptime_gaps(read_table(spark, sf_dir, "events"), 3600.0))


@register("uptime_availability")
def q_uptime_availability(spark, sf_dir):
    return round_doubles(L.availability(read_table(spark, sf_dir, "events"), 5, "hour"))


@register("retention")
def q_retention(spark, sf_dir):
    return L.retention(read_table(spark, sf_dir, "events"), prefix="error-", days=2)


@register("retention_sweep")
def q_retention_sweep(spark, sf_dir):
    # Events in one folder per daily set; expired sets are dropped whole, from
    # the listing of the files.
    events = read_table(spark, sf_dir, "events")
    table = ST.SetTable(scratch_path(spark, "sets"))
    table.write(events)
    as_of = events.agg(F.max(F.to_date("ts"))).first()[0]
    table.sweep(spark, "error-", 2, as_of).collect()
    return table.read(spark)


@register("retention_sweep_stream")
def q_retention_sweep_stream(spark, sf_dir):
    # Events arrive in folders by day, oldest first; every micro-batch sweeps.
    events = read_table(spark, sf_dir, "events")
    root = scratch_path(spark, "sets-stream")
    LD.land(events.withColumn("day", F.to_date("ts")), f"{root}/events", partition_by=("day",))
    table = ST.SetTable(f"{root}/sets")
    src = SE.file_stream(spark, f"{root}/events", events.schema, max_files_per_trigger=16)
    ST.retained_sets_stream(src.drop("day"), table, f"{root}/chk", "error-", 2).awaitTermination()
    # files are taken in any order: one sweep at the newest time of all
    as_of = events.agg(F.max(F.to_date("ts"))).first()[0]
    table.sweep(spark, "error-", 2, as_of).collect()
    return table.read(spark)


@register("uptime_gaps_stream")
def q_uptime_gaps_stream(spark, sf_dir):
    # Heartbeats arrive in folders by day; closed sessions are written as the
    # watermark passes them.  A clock tick after the last day closes the rest.
    events = read_table(spark, sf_dir, "events")
    root = scratch_path(spark, "beats")
    LD.land(events.withColumn("day", F.to_date("ts")), f"{root}/events", partition_by=("day",))
    newest = events.agg(F.max("ts")).first()[0]

    def run():
        src = SE.file_stream(spark, f"{root}/events", events.schema, max_files_per_trigger=64)
        # files are taken in any order, so the watermark spans the data
        HB.beat_sessions_stream(src.drop("day"), f"{root}/sessions", f"{root}/chk", 3600.0,
                                "31 days").awaitTermination()

    run()
    tick = HB.clock_tick(events, newest + dt.timedelta(days=32))
    LD.land(tick.withColumn("day", F.to_date("ts")), f"{root}/events", partition_by=("day",),
            mode="append")
    run()
    sessions = spark.read.parquet(f"{root}/sessions")
    return round_doubles(HB.gaps_of_sessions(sessions, 3600.0, kind=events.schema["ts"].dataType))


@register("word_count_stream")
def q_word_count_stream(spark, sf_dir):
    # Documents arrive in folders by source; each micro-batch adds its counts.
    docs = read_table(spark, sf_dir, "documents").select("source", "text")
    root = scratch_path(spark, "words")
    LD.land(docs, f"{root}/docs", partition_by=("source",))
    log = SC.word_log(f"{root}/table")
    src = SE.file_stream(spark, f"{root}/docs", docs.schema, max_files_per_trigger=2)
    SC.word_count_stream(src, log, f"{root}/chk").awaitTermination()
    return log.read(spark)


# --- log lines with any payload (R2) -------------------------------------------

def json_log_lines(spark: SparkSession, sf_dir: str):
    """Log lines as text, as a shipper tails them: events as JSON objects whose payload
    is nested and whose keys differ by type, beside lines that are not JSON (one for
    each nation).  Returns the folder."""
    events = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    line = F.to_json(F.struct(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event_type",
        F.struct(k.alias("k"), F.array(k, F.col("user_id")).alias("seen")).alias("props"),
        F.when(F.col("event_type") == "error", F.struct(F.col("user_id").alias("user")))
        .alias("failed by")))
    path = scratch_path(spark, "log-lines")
    events.select(line.alias("value")).write.mode("overwrite").text(f"{path}/kind=events")
    (read_table(spark, sf_dir, "nation")
     .select(F.concat(F.lit('{"broken": "'), "n_name").alias("value"))
     .coalesce(1).write.mode("overwrite").text(f"{path}/kind=broken"))
    return path


@register("log_fields")
def q_log_fields(spark, sf_dir):
    # Every leaf of every payload, whatever its keys.
    lines = spark.read.text(json_log_lines(spark, sf_dir)).select("value")
    good, _ = PL.split_lines(PL.parse_lines(lines))
    fields = PL.payload_fields(good.withColumn("event_id", F.variant_get(
        PL.PAYLOAD, "$.event_id", "long")), ["event_id"], depth=3)
    return fields.select("event_id", "path", "value")


@register("log_bad_lines")
def q_log_bad_lines(spark, sf_dir):
    lines = spark.read.text(json_log_lines(spark, sf_dir)).select("value")
    _, bad = PL.split_lines(PL.parse_lines(lines))
    return bad.select(F.col("value").alias("line"))


@register("log_payload_schema")
def q_log_payload_schema(spark, sf_dir):
    # The schema that all payloads have together, as text.
    lines = spark.read.text(json_log_lines(spark, sf_dir)).select("value")
    good, _ = PL.split_lines(PL.parse_lines(lines))
    return PL.payload_schema(good)


@register("log_ingest_any_stream")
def q_log_ingest_any_stream(spark, sf_dir):
    # The lines as a stream: payloads as VARIANT in one table, bad lines in
    # another; typed columns are taken out of the payload when it is read.
    root = scratch_path(spark, "log-any")
    src = (spark.readStream.text(json_log_lines(spark, sf_dir)).select("value"))
    SE.any_log_stream(src, f"{root}/out", f"{root}/chk").awaitTermination()
    good, _ = SE.read_any_log(spark, f"{root}/out")
    typed = PL.typed_payload(good, T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("ts", T.StringType())]))
    return typed


# --- shaping (W9-W13) -------------------------------------------------------


BAR_NAMES = [f.name for f in BAR.fields]


@register("split_adjust")
def q_split_adjust(spark, sf_dir):
    return B.split_adjust(bars(spark, sf_dir), 20)


@register("derived_columns")
def q_derived_columns(spark, sf_dir):
    return B.derived_columns(B.split_adjust(bars(spark, sf_dir), 20))


@register("normalise_bars")
def q_normalise_bars(spark, sf_dir):
    # Downloader-style input: lower-case names and no adjusted close.
    raw = bars(spark, sf_dir).drop("Adj Close")
    lower = raw.toDF(*[c.lower() for c in raw.columns])
    return B.normalise_bars(lower, renames={c.lower(): c for c in raw.columns},
                            date_as_string=True)


@register("coerce_defaults")
def q_coerce_defaults(spark, sf_dir):
    # Bar rows read into the document schema: absent derived fields -> 0.
    return B.coerce_defaults(bars(spark, sf_dir), STOCK_DOC, default=0)


@register("null_normalise")
def q_null_normalise(spark, sf_dir):
    # Yearly stats written as text with the token 'NULL' for missing values,
    # read back as strings, then normalised and typed again.
    yearly = round_doubles(P.yearly_stats(bars(spark, sf_dir), digits=4))
    path = scratch_path(spark, "null-normalise")
    yearly.write.mode("overwrite").option("header", "true").option("nullValue", "NULL").csv(path)
    text = CSV.read_csv(spark, path, T.StructType(
        [T.StructField(f.name, T.StringType(), True) for f in YEARLY.fields]),
        keep_corrupt=False)
    return B.coerce_defaults(B.null_normalise(text), YEARLY)


# --- sinks (W29-W35) ------------------------------------------------------------

@register("to_points")
def q_to_points(spark, sf_dir):
    pts = PT.bar_points(B.derived_columns(bars(spark, sf_dir)), digits=6)
    return pts.select("symbol", "Date", "time_ns", "line")


@register("to_points_stats")
def q_to_points_stats(spark, sf_dir):
    pts = PT.stats_points(P.period_stats_long(bars(spark, sf_dir), digits=6), digits=6)
    return pts.select("symbol", "period_type", "period", "time_ns", "line")


@register("to_documents")
def q_to_documents(spark, sf_dir):
    return D.stats_documents(round_doubles(P.period_stats_long(bars(spark, sf_dir), digits=4)))


@register("upsert_bars")
def q_upsert_bars(spark, sf_dir):
    # Base: bars of closed lines; delta: bars of open lines replace them by key.
    li = read_table(spark, sf_dir, "lineitem")
    base = bars_of(li.where(F.col("l_linestatus") == "F"))
    delta = bars_of(li.where(F.col("l_linestatus") == "O"))
    # bars are unique per (symbol, Date) by construction
    return U.upsert(base, delta, ["symbol", "Date"], delta_unique=True)


@register("upsert_bars_corrections")
def q_upsert_bars_corrections(spark, sf_dir):
    # A delta that holds every open bar twice: first with twice its volume,
    # then corrected at a later version, which wins.
    li = read_table(spark, sf_dir, "lineitem")
    base = bars_of(li.where(F.col("l_linestatus") == "F"))
    first = bars_of(li.where(F.col("l_linestatus") == "O"))
    delta = first.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    delta = delta.withColumn("Volume", F.col("Volume") * (3 - F.col("version")))
    return U.upsert(base, delta, ["symbol", "Date"], ["version"]).drop("version")


@register("land_bars")
def q_land_bars(spark, sf_dir):
    path = LD.land(bars(spark, sf_dir), scratch_path(spark, "land-bars"))
    return spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in BAR_NAMES], "year")


def sent_store(spark: SparkSession, docs: DataFrame) -> BK.BulkStore:
    """``docs`` sent twice, from different numbers of tasks."""
    root = scratch_path(spark, "bulk")
    docs = materialize(docs, "bulk-docs")
    BK.send(docs.repartition(3), root, "run-1")
    BK.send(docs.repartition(7), root, "run-2")
    return BK.BulkStore(spark, root)


@register("sink_report")
def q_sink_report(spark, sf_dir):
    docs = D.stats_documents(P.period_stats_long(bars(spark, sf_dir)))
    tallies = sent_store(spark, docs).tallies()
    return tallies.where("run = 'run-2'").select("target", "written", "failed")


@register("sink_documents")
def q_sink_documents(spark, sf_dir):
    # What the store holds after both sends: each document once.
    docs = D.stats_documents(round_doubles(P.period_stats_long(bars(spark, sf_dir), digits=4)))
    return sent_store(spark, docs).documents()


@register("sink_refused")
def q_sink_refused(spark, sf_dir):
    # Documents that the store refuses: no id, or a source that is no object.
    nation = read_table(spark, sf_dir, "nation")
    docs = nation.select(
        F.lit("nation").alias("_index"),
        F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("_id"),
        F.when(F.col("n_regionkey") == 1, F.col("n_name")).otherwise(
            F.to_json(F.struct("n_nationkey"))).alias("_source"))
    return (sent_store(spark, docs).refused().where("run = 'run-2'")
            .select("_index", "_id", "_source", "reason"))


@register("declared_target")
def q_declared_target(spark, sf_dir):
    # A target is declared once; declaring it again changes nothing, and another
    # schema is refused.  Its rows conform to the declared schema.
    path = scratch_path(spark, "target")
    created = D.create_target(spark, path, D.STATS_DOC)
    again = D.create_target(spark, path, D.STATS_DOC)
    try:
        D.create_target(spark, path, STOCK_DOC)
        refused = False
    except D.TargetMismatch:
        refused = True
    D.write_target(P.period_stats_long(bars(spark, sf_dir)), path)
    rows = spark.read.parquet(f"{path}/data")
    return rows.groupBy("period_type").agg(F.count(F.lit(1)).alias("n")).select(
        "period_type", "n", F.lit(created).alias("created"), F.lit(again).alias("created_again"),
        F.lit(refused).alias("other_refused"))


@register("file_manifest")
def q_file_manifest(spark, sf_dir):
    # The listing of the driver's own table files with their rows.
    paths = [table_path(sf_dir, t) for t in TABLES]
    found = MF.file_manifest(spark, paths)
    return found.select("file_name", "rows", (F.col("file_size") > 0).alias("has_bytes"),
                        F.col("modified").isNotNull().alias("has_time"))


@register("verify_landed")
def q_verify_landed(spark, sf_dir):
    # Bars landed as Parquet by year, as CSV, and with one symbol left out:
    # each copy against its source.
    b = materialize(bars(spark, sf_dir), "verify-source")
    copies = {"parquet": spark.read.parquet(LD.land(b, scratch_path(spark, "verify"))),
              "csv": CSV.read_csv(spark, LD.land_csv(b, scratch_path(spark, "verify-csv")), BAR),
              "part": b.where(F.col("symbol") != "R")}
    checks = [MF.verify_landed(b, c).select(F.lit(k).alias("copy"), "*")
              for k, c in copies.items()]
    return checks[0].unionAll(checks[1]).unionAll(checks[2])


@register("file_rows")
def q_file_rows(spark, sf_dir):
    # Manifest of the driver's own table files: rows per file (sizes and
    # times are in file_manifest).
    paths = [table_path(sf_dir, t) for t in TABLES]
    return MF.file_manifest(spark, paths).select("file_name", "rows")


@register("preview_lines")
def q_preview_lines(spark, sf_dir):
    path = LD.land_csv(bars(spark, sf_dir), scratch_path(spark, "preview"))
    first = (MF.file_manifest(spark, path, "text").orderBy("file_name")
             .select("file_path").first()[0])
    return MF.preview_lines(spark, first, 5)


# --- CSV sources (W1-W3) ---------------------------------------------------------

@register("scan_csv")
def q_scan_csv(spark, sf_dir):
    path = LD.land_csv(bars(spark, sf_dir), scratch_path(spark, "scan-csv"))
    return CSV.read_csv(spark, path, BAR).drop(CSV.CORRUPT)


@register("union_by_name_missing")
def q_union_by_name_missing(spark, sf_dir):
    b = bars(spark, sf_dir)
    with_adj = LD.land_csv(b.where(F.col("symbol") == "R"), scratch_path(spark, "union-a"))
    without = LD.land_csv(b.where(F.col("symbol") != "R").drop("Adj Close"),
                          scratch_path(spark, "union-b"))
    text = CSV.read_csv_union(spark, [with_adj, without])
    return B.coerce_defaults(text, BAR)


@register("bars_csv")
def q_bars_csv(spark, sf_dir):
    # Bars landed as CSV in symbol=<S> folders, read back as typed bars.
    path = LD.land_csv(bars(spark, sf_dir), scratch_path(spark, "bars-csv"), ["symbol"])
    return CSV.read_bar_csv(spark, path).drop(CSV.CORRUPT)


@register("scan_csv_lenient")
def q_scan_csv_lenient(spark, sf_dir):
    # One landed folder and one that does not exist: the missing path is
    # reported, the rest is read.
    path = LD.land_csv(bars(spark, sf_dir), scratch_path(spark, "lenient"))
    df, missing = CSV.read_csv_union(spark, [path, path + "-missing"], BAR, lenient=True)
    assert missing == [path + "-missing"]
    return df.drop(CSV.CORRUPT)


@register("scan_csv_corrupt")
def q_scan_csv_corrupt(spark, sf_dir):
    scan, _ = csv_with_bad_lines(spark, sf_dir)
    return CSV.corrupt_counts(scan)


def csv_with_bad_lines(spark: SparkSession, sf_dir: str):
    """Events landed as CSV beside lines that do not fit their types, one for
    each nation: (scan, column names)."""
    events = read_table(spark, sf_dir, "events")
    root = scratch_path(spark, "events-csv")
    LD.land_csv(events, f"{root}/good")
    key, *rest = events.columns
    LD.land_csv(read_table(spark, sf_dir, "nation").select(
        F.concat(F.lit("bad-"), F.col("n_nationkey").cast("string")).alias(key),
        *[F.col("n_name").alias(c) for c in rest]), f"{root}/bad")
    return CSV.read_csv(spark, [f"{root}/good", f"{root}/bad"], events.schema), events.columns


@register("corrupt_lines")
def q_corrupt_lines(spark, sf_dir):
    # The lines that do not fit, with their text.
    scan, _ = csv_with_bad_lines(spark, sf_dir)
    _, bad = CSV.split_corrupt(scan)
    return bad.select(F.col(CSV.CORRUPT).alias("line"))


@register("scan_csv_all_lines")
def q_scan_csv_all_lines(spark, sf_dir):
    # Every line: typed where it fits, with its text where it does not.
    scan, _ = csv_with_bad_lines(spark, sf_dir)
    return scan.select("event_id", "event_type", F.col(CSV.CORRUPT).alias("bad_line"))


@register("scan_csv_multiline")
def q_scan_csv_multiline(spark, sf_dir):
    # Texts with line breaks, quotes and outer blanks as quoted fields.
    docs = read_table(spark, sf_dir, "documents")
    path = LD.land(docs, scratch_path(spark, "csv-docs"), (), fmt="csv", options={
        "header": "true", "escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false"})
    return CSV.read_csv(spark, path, docs.schema, options=CSV.MULTILINE).drop(CSV.CORRUPT)


@register("union_declared_headers")
def q_union_declared_headers(spark, sf_dir):
    # Files whose headers differ in order and columns, one with lines that do
    # not fit, under one declared schema.
    b = bars(spark, sf_dir)
    a = LD.land_csv(b.where(F.col("symbol") == "R"), scratch_path(spark, "union-r"))
    c = LD.land_csv(b.where(F.col("symbol") != "R").select("Close", "Date", "symbol", "Volume"),
                    scratch_path(spark, "union-rest"))
    bad = LD.land_csv(read_table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("symbol"), F.lit("no date").alias("Date")),
        scratch_path(spark, "union-bad"))
    out = CSV.read_csv_union(spark, [a, c, bad], BAR)
    return out.select("symbol", "Date", "Open", "Close", "Volume",
                      F.col(CSV.CORRUPT).alias("bad_line"))


@register("bars_csv_extra_columns")
def q_bars_csv_extra_columns(spark, sf_dir):
    # The downloader's layout: two more columns, adjusted close last.
    b = bars(spark, sf_dir)
    wide = b.select("symbol", "Date", "Open", "High", "Low", "Close", "Volume",
                    F.lit(0.0).alias("Dividends"), F.lit(0.0).alias("Stock Splits"), "Adj Close")
    path = LD.land_csv(wide, scratch_path(spark, "bars-csv-wide"), ["symbol"])
    return CSV.read_bar_csv(spark, path).drop(CSV.CORRUPT)


@register("bars_csv_no_adj_close")
def q_bars_csv_no_adj_close(spark, sf_dir):
    path = LD.land_csv(bars(spark, sf_dir).drop("Adj Close"),
                       scratch_path(spark, "bars-csv-narrow"), ["symbol"])
    return CSV.read_bar_csv(spark, path).drop(CSV.CORRUPT)


# --- streaming (R2, R3, R6) ------------------------------------------------------

@register("log_ingest_stream")
def q_log_ingest_stream(spark, sf_dir):
    src_path = table_path(sf_dir, "events")
    schema = spark.read.parquet(src_path).schema
    root = scratch_path(spark, "log-ingest")
    q = SE.log_ingest_stream(SE.file_stream(spark, SE.single_file_glob(src_path), schema),
                             f"{root}/out", f"{root}/chk")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("log_ingest_json_stream")
def q_log_ingest_json_stream(spark, sf_dir):
    # Log lines as JSON files (what a shipper tails), ingested as a stream.
    events = read_table(spark, sf_dir, "events")
    root = scratch_path(spark, "log-json")
    LD.land_json(events, f"{root}/logs")
    src = SE.file_stream(spark, f"{root}/logs", events.schema, fmt="json",
                         max_files_per_trigger=4)
    q = SE.log_ingest_stream(src, f"{root}/out", f"{root}/chk")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("metric_window_stream")
def q_metric_window_stream(spark, sf_dir):
    src_path = table_path(sf_dir, "events")
    schema = spark.read.parquet(src_path).schema
    root = scratch_path(spark, "metric-window")
    table = U.ChangeLog(f"{root}/table", ["window_start", "event_type"])
    q = SE.metric_window_stream(SE.file_stream(spark, SE.single_file_glob(src_path), schema),
                                table, f"{root}/chk", "10 seconds", "1 hour")
    q.awaitTermination()
    return round_doubles(table.read(spark))


@register("metric_window_stream_daily_files")
def q_metric_window_stream_daily_files(spark, sf_dir):
    # Events arrive as one folder per day, several micro-batches: window state
    # carries across batches.  The watermark spans the data (31 days), so no
    # row is late whatever order the files are taken in: equals the batch.
    events = read_table(spark, sf_dir, "events")
    root = scratch_path(spark, "metric-daily")
    LD.land(events.withColumn("day", F.to_date("ts")), f"{root}/events", partition_by=("day",))
    table = U.ChangeLog(f"{root}/table", ["window_start", "event_type"])
    src = SE.file_stream(spark, f"{root}/events", events.schema, max_files_per_trigger=64)
    q = SE.metric_window_stream(src.drop("day"), table, f"{root}/chk", "10 seconds", "31 days")
    q.awaitTermination()
    return round_doubles(table.read(spark))


@register("bars_from_tick_stream")
def q_bars_from_tick_stream(spark, sf_dir):
    # Ticks arrive as files (one folder per ship year, several micro-batches);
    # each writes the parts of bars that its ticks make, a read merges them.
    ticks = read_table(spark, sf_dir, "lineitem")
    root = scratch_path(spark, "tick-stream")
    LD.land(ticks.withColumn("year", F.year("l_shipdate")), f"{root}/ticks",
            partition_by=("year",))
    log = SC.tick_bar_log(f"{root}/table")
    src = SE.file_stream(spark, f"{root}/ticks", ticks.schema, max_files_per_trigger=2)
    SC.tick_bar_stream(src.drop("year"), log, f"{root}/chk").awaitTermination()
    return SC.read_tick_bars(spark, log)


@register("period_stats_incremental")
def q_period_stats_incremental(spark, sf_dir):
    # Statistics kept up to date from new bar files: moments of each micro-batch
    # are merged, history is not read again.
    root = scratch_path(spark, "period-stream")
    landed = LD.land(bars(spark, sf_dir), f"{root}/bars")
    schema = T.StructType(list(BAR.fields) + [T.StructField("year", T.IntegerType(), True)])
    log = SC.period_log(f"{root}/table")
    src = SE.file_stream(spark, landed, schema, max_files_per_trigger=2)
    SC.period_stats_stream(src.drop("year"), log, f"{root}/chk").awaitTermination()
    return round_doubles(SC.read_period_stats(spark, log, digits=4))


@register("period_quartiles")
def q_period_quartiles(spark, sf_dir):
    # sketches of months, merged to quarters and years
    return SK.period_quartiles(SK.month_sketches(bars(spark, sf_dir)))


@register("period_quartiles_incremental")
def q_period_quartiles_incremental(spark, sf_dir):
    # The same from new bar files: each micro-batch stores its own sketches.
    root = scratch_path(spark, "quartile-stream")
    landed = LD.land(bars(spark, sf_dir), f"{root}/bars")
    schema = T.StructType(list(BAR.fields) + [T.StructField("year", T.IntegerType(), True)])
    log = SC.sketch_log(f"{root}/table")
    src = SE.file_stream(spark, landed, schema, max_files_per_trigger=2)
    SC.quartile_stream(src.drop("year"), log, f"{root}/chk").awaitTermination()
    return SC.read_quartiles(spark, log)


@register("incremental_bars")
def q_incremental_bars(spark, sf_dir):
    root = scratch_path(spark, "increments")
    landed = LD.land(bars(spark, sf_dir), f"{root}/landing")
    schema = T.StructType(list(BAR.fields) + [T.StructField("year", T.IntegerType(), True)])
    table = U.ChangeLog(f"{root}/table", list(SI.BAR_KEYS))
    q = SI.incremental_bars_stream(
        SE.file_stream(spark, landed, schema, max_files_per_trigger=4), table, f"{root}/chk")
    q.awaitTermination()
    return table.read(spark).select(*[F.col(f"`{c}`") for c in BAR_NAMES])


def _bar_file_stream(spark: SparkSession, sf_dir: str, root: str, corrected: bool):
    """Bars landed as files; ``corrected``: an older version of each, with twice the
    volume, lies in files that were written before."""
    b = materialize(bars(spark, sf_dir), "increment-bars")
    if corrected:
        LD.land(b.withColumn("Volume", F.col("Volume") * 2), f"{root}/landing")
    LD.land(b, f"{root}/landing", mode="append")
    schema = T.StructType(list(BAR.fields) + [T.StructField("year", T.IntegerType(), True)])
    return SE.file_stream(spark, f"{root}/landing", schema)


@register("incremental_bars_corrections")
def q_incremental_bars_corrections(spark, sf_dir):
    # Both versions of every bar in one trigger: the later file's wins.
    root = scratch_path(spark, "corrections")
    table = U.ChangeLog(f"{root}/table", list(SI.BAR_KEYS))
    SI.incremental_bars_stream(_bar_file_stream(spark, sf_dir, root, True), table,
                               f"{root}/chk").awaitTermination()
    return table.read(spark).select(*[F.col(f"`{c}`") for c in BAR_NAMES])


@register("incremental_points")
def q_incremental_points(spark, sf_dir):
    # The points of new bars: six fields, no derived ones.
    root = scratch_path(spark, "increment-points")
    table = U.ChangeLog(f"{root}/table", list(SI.BAR_KEYS))
    SI.incremental_bars_stream(_bar_file_stream(spark, sf_dir, root, False), table,
                               f"{root}/chk", points_path=f"{root}/points",
                               point_digits=6).awaitTermination()
    return spark.read.text(f"{root}/points").select(F.col("value").alias("line"))


@register("scalar_epoch_size")
def q_scalar_epoch_size(spark, sf_dir):
    # Epoch milliseconds as text, and readable sizes.
    events = read_table(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    size = F.col("event_id") * F.col("event_id") * 1000
    return events.select("event_id", epoch_millis_text(ms).alias("time_text"),
                         MF.human_size(size).alias("size_text"))
