"""Rendering sinks: points, documents, batched writer tallies, landing."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlestack.operators import bars as B
from candlestack.operators import periods as P
from candlestack.sinks import documents as D
from candlestack.sinks import landing as LD
from candlestack.sinks import points as PT
from candlestack.sinks import report as RP
from candlestack.sources import manifest as MF

BAR_DDL = ("symbol string, Date date, Open double, High double, Low double, Close double, "
           "`Adj Close` double, Volume long")


def _bars(spark):
    return spark.createDataFrame(
        [("A", dt.date(2020, 1, 2), 0.0, 2.0, 0.0, 1.5, 1.5, 100),
         ("A b", dt.date(2021, 3, 4), 10.0, 12.5, 9.0, 11.0, 11.0, 7)], BAR_DDL)


def test_bar_points_line_protocol(spark):
    pts = {r.symbol: r for r in PT.bar_points(B.derived_columns(_bars(spark)), digits=6).collect()}
    a = pts["A"].line
    assert a.startswith("stock_prices,symbol=A open=0,high=2,low=0,close=1.5,")
    assert "return=" not in a                      # NULL field left out (Open = 0)
    assert a.endswith(" 1577923200000000000")      # 2020-01-02T00:00:00Z in ns
    assert pts["A b"].line.startswith(r"stock_prices,symbol=A\ b open=10,")


def test_stats_points_tags_and_int_field(spark):
    long = P.period_stats_long(_bars(spark))
    lines = [r.line for r in PT.stats_points(long).collect()]
    yearly = [x for x in lines if "period_type=yearly" in x and "symbol=A," in x][0]
    assert ",year=2020 " in yearly and "trading_days=1i" in yearly
    q = [x for x in lines if "quarter=2021-Q1" in x][0]
    assert q.endswith(str(int(dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc).timestamp())
                          * 1_000_000_000))


def test_documents_keyed_and_routed(spark):
    docs = D.stats_documents(P.period_stats_long(_bars(spark))).collect()
    ids = [d._id for d in docs]
    assert len(ids) == len(set(ids)) == 6
    assert {d._index for d in docs} == {"stock_monthly", "stock_quarterly", "stock_yearly"}
    src = json.loads([d for d in docs if d._id == "A|yearly|2020"][0]._source)
    assert src["YoY_Growth"] is None and src["Trading_Days"] == 1
    assert list(src)[:3] == ["symbol", "period_type", "period"]


def test_send_in_batches_tallies(spark, tmp_dir):
    df = spark.range(0, 2500).withColumn("_index", F.when(F.col("id") < 2000, "x").otherwise("y"))
    tally = {r.target: (r.written, r.failed)
             for r in RP.send_in_batches(df, RP.JsonLinesWriter(tmp_dir), batch_size=300).collect()}
    assert tally == {"x": (2000, 0), "y": (500, 0)}
    back = spark.read.json(f"{tmp_dir}/x").count()
    assert back == 2000

    def failing(target, name, batch):
        raise RuntimeError("store down")

    bad = RP.send_in_batches(df, failing, batch_size=300).agg(F.sum("failed")).collect()[0][0]
    assert bad == 2500


def test_land_and_manifest(spark, tmp_dir):
    path = LD.land(_bars(spark), f"{tmp_dir}/bars")
    back = spark.read.parquet(path)
    assert sorted(r.year for r in back.collect()) == [2020, 2021]
    assert back.where("year = 2021").count() == 1     # partition pruning path
    man = MF.file_manifest(spark, path).collect()
    assert sum(r.rows for r in man) == 2 and all(r.file_size > 0 for r in man)
    assert all(r.size_text.endswith(("B", "KB")) for r in man)
    csv = LD.land_csv(_bars(spark), f"{tmp_dir}/csv")
    first = sorted(MF.file_manifest(spark, csv, "text").collect(), key=lambda r: r.file_name)[0]
    lines = MF.preview_lines(spark, first.file_path, 5).collect()
    assert lines[0].value.startswith("symbol,Date,Open")


def test_create_target_if_absent(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert D.target_schema(spark, path) is None
    with pytest.raises(D.TargetMismatch):
        D.write_target(spark.createDataFrame([("A",)], "symbol string"), path)
    assert D.create_target(spark, path, D.STATS_DOC)
    assert not D.create_target(spark, path, D.STATS_DOC)        # exists: untouched
    assert D.target_schema(spark, path) == D.STATS_DOC
    other = T.StructType([*D.STATS_DOC.fields[1:], T.StructField("extra", T.LongType())])
    with pytest.raises(D.TargetMismatch, match="extra, symbol"):
        D.create_target(spark, path, other)
    row = spark.range(2).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                  for f in reversed(D.STATS_DOC.fields)])
    D.write_target(row, path)
    back = spark.read.parquet(f"{path}/data")
    assert back.schema == D.STATS_DOC and back.count() == 2


def test_text_landing_keeps_microseconds(spark, tmp_dir):
    from candlestack.sources import csv as CSV

    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(1, ts, "a,b \"q\"")], "id long, ts timestamp_ntz, s string")
    LD.land_csv(df, f"{tmp_dir}/c")
    back = CSV.read_csv(spark, f"{tmp_dir}/c", df.schema, keep_corrupt=False).collect()[0]
    assert (back.ts, back.s) == (ts, 'a,b "q"')
    LD.land_json(df, f"{tmp_dir}/j")
    from candlestack.streaming.events import TEXT_TIME_OPTIONS
    j = spark.read.schema(df.schema).options(**TEXT_TIME_OPTIONS).json(f"{tmp_dir}/j").collect()[0]
    assert j.ts == ts


def test_read_bar_csv_with_symbol_and_missing_adj_close(spark, tmp_dir):
    import os
    from candlestack.sources import csv as CSV

    os.makedirs(tmp_dir, exist_ok=True)
    with open(f"{tmp_dir}/one.csv", "w") as f:
        f.write("Date,Open,High,Low,Close,Volume\n2020-01-02,1.0,2.0,0.5,1.5,100\n")
    schema = "Date date, Open double, High double, Low double, Close double, Volume long"
    r = CSV.read_bar_csv(spark, f"{tmp_dir}/one.csv", schema=schema_of(spark, schema),
                         symbol="X").collect()[0]
    assert (r.symbol, r["Adj Close"], r.Volume) == ("X", 1.5, 100)


def test_bar_csv_columns_are_found_by_name(spark, tmp_dir):
    import os
    from candlestack.sources import csv as CSV

    os.makedirs(tmp_dir, exist_ok=True)
    with open(f"{tmp_dir}/wide.csv", "w") as f:
        f.write("Date,Open,High,Low,Close,Volume,Dividends,Stock Splits,Adj Close\n"
                "2020-01-02,1.0,2.0,0.5,1.5,100,0.0,0.0,1.25\n"
                "2020-01-03,oops,2.0,0.5,1.5,100,0.0,0.0,1.25\n")
    with open(f"{tmp_dir}/narrow.csv", "w") as f:
        f.write("Volume,Date,Open,High,Low,Close\n7,2020-01-06,1.0,2.0,0.5,1.5\n")
    df = CSV.read_bar_csv(spark, [f"{tmp_dir}/wide.csv", f"{tmp_dir}/narrow.csv"], symbol="X")
    good, bad = CSV.split_corrupt(df)
    got = sorted((str(r.Date), r.Close, r["Adj Close"], r.Volume) for r in good.collect())
    assert got == [("2020-01-02", 1.5, 1.25, 100), ("2020-01-06", 1.5, 1.5, 7)]
    assert [r[CSV.CORRUPT].split(",")[1] for r in bad.collect()] == ["oops"]


def test_points_leave_out_what_line_protocol_cannot_hold(spark):
    df = spark.createDataFrame([("a\nb", "", float("nan"), float("inf"), 100.0)],
                               "s string, e string, x double, y double, z double")
    pts = PT.to_points(df, "m", {"s": "s", "e": "e"}, {"x": "x", "y": "y", "z": "z"},
                       PT.F.lit(1).cast("long"), digits=2)
    assert pts.first().line == "m,s=a\\ b z=100 1"


def schema_of(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_normalise_fills_null_adj_close(spark):
    from candlestack.operators import bars as B

    df = spark.createDataFrame([("A", dt.date(2020, 1, 2), 1.0, 2.0, None)],
                               "symbol string, Date date, Open double, Close double, `Adj Close` double")
    r = B.normalise_bars(df, date_as_string=True).collect()[0]
    assert r["Adj Close"] == 2.0 and r.Date == "2020-01-02"


def test_write_points_text(spark, tmp_dir):
    pts = PT.bar_points(B.derived_columns(_bars(spark)), digits=4)
    PT.write_points(pts, f"{tmp_dir}/pts")
    lines = sorted(r.value for r in spark.read.text(f"{tmp_dir}/pts").collect())
    assert len(lines) == 2 and all(x.startswith("stock_prices,symbol=") for x in lines)


def test_batch_writer_runs_where_executors_lack_the_package(tmp_path):
    # Executors start in the driver's working folder; from elsewhere they
    # cannot import this package, so the per-partition code must ship by value.
    import os
    import subprocess
    import sys

    from conftest import ROOT

    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from candlestack.session import local_session, scratch_path
from candlestack.sinks import report as RP
from pyspark.sql import functions as F
spark = local_session(2)
df = spark.range(0, 300).withColumn("_index", F.lit("t"))
rows = RP.send_in_batches(df, RP.JsonLinesWriter(scratch_path(spark, "ship")), batch_size=50)
print(sorted(map(tuple, rows.collect())))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "[('t', 300, 0)]" in out.stdout, out.stderr[-2000:]


def test_period_tables_conform_to_declared_targets(spark):
    from candlestack.operators import periods as P
    from candlestack.schemas import DOC_TARGETS

    b = _bars(spark)
    tables = {"monthly": P.monthly_stats(b), "quarterly": P.quarterly_stats(b),
              "yearly": P.yearly_stats(b),
              "daily": B.derived_columns(b)}
    for level, df in tables.items():
        typed = D.conform(df, DOC_TARGETS[level])
        assert [(f.name, f.dataType) for f in typed.schema] == \
            [(f.name, f.dataType) for f in DOC_TARGETS[level]]
        assert typed.count() == df.count()
