"""Structured Streaming operators: stream equals batch; late rows dropped."""

import datetime as dt

from pyspark.sql import functions as F

from candlestack.operators import logs as L
from candlestack.sinks import upsert as U
from candlestack.streaming import counts as SC
from candlestack.streaming import events as SE
from candlestack.streaming import heartbeats as HB
from candlestack.streaming import increments as SI

EVENTS_DDL = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
              "value double, props string")


def _order_by_mtime(root, folders):
    """File streams take files in modification-time order: make it explicit."""
    import os
    import time
    base = time.time() - 100
    for i, folder in enumerate(folders):
        for name in os.listdir(os.path.join(root, folder)):
            os.utime(os.path.join(root, folder, name), (base + i * 10, base + i * 10))


def _events(spark, rows):
    return spark.createDataFrame(rows, EVENTS_DDL)


def test_late_event_dropped_in_stream_present_in_batch(spark, tmp_dir):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    first = _events(spark, [(1, t0, 1, "click", 1.0, '{"k": 1}'),
                            (2, t0 + dt.timedelta(hours=3), 1, "click", 2.0, '{"k": 2}')])
    middle = _events(spark, [(4, t0 + dt.timedelta(hours=3, seconds=1), 1, "click", 3.0,
                              '{"k": 4}')])
    late = _events(spark, [(3, t0 + dt.timedelta(seconds=1), 1, "click", 5.0, '{"k": 3}')])
    # One file per micro-batch.  Late rows are judged against the watermark
    # of the previous batch, so the late row comes two batches after t0+3h.
    first.coalesce(1).write.parquet(f"{tmp_dir}/src/part=0")
    middle.coalesce(1).write.parquet(f"{tmp_dir}/src/part=1")
    late.coalesce(1).write.parquet(f"{tmp_dir}/src/part=2")
    _order_by_mtime(f"{tmp_dir}/src", ["part=0", "part=1", "part=2"])
    schema = first.schema
    table = U.ChangeLog(f"{tmp_dir}/table", ["window_start", "event_type"])
    q = SE.metric_window_stream(
        SE.file_stream(spark, f"{tmp_dir}/src/part=*", schema, max_files_per_trigger=1),
        table, f"{tmp_dir}/chk", "10 seconds", "1 hour")
    q.awaitTermination()
    streamed = {r.window_start: r.n for r in table.read(spark).collect()}
    batch = {r.window_start: r.n
             for r in L.metric_window(first.unionByName(middle).unionByName(late),
                                    "10 seconds").collect()}
    assert batch[t0] == 2            # the batch twin sees the late row
    assert streamed[t0] == 1         # the stream dropped it (behind the watermark)
    assert len(streamed) == len(batch) == 2
    assert sum(streamed.values()) == 3 and sum(batch.values()) == 4


def test_log_ingest_stream_equals_batch(spark, tmp_dir):
    t0 = dt.datetime(2024, 1, 1)
    ev = _events(spark, [(i, t0 + dt.timedelta(minutes=i), i, "view", float(i), f'{{"k": {i}}}')
                         for i in range(20)])
    ev.repartition(3).write.parquet(f"{tmp_dir}/src")
    q = SE.log_ingest_stream(SE.file_stream(spark, f"{tmp_dir}/src", ev.schema, max_files_per_trigger=1),
                             f"{tmp_dir}/out", f"{tmp_dir}/chk")
    q.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out").collect()))
    want = sorted(map(tuple, L.parse_events(ev).collect()))
    assert got == want


def test_incremental_bars_keyed_and_replay_safe(spark, tmp_dir):
    ddl = ("symbol string, Date date, Open double, High double, Low double, Close double, "
           "`Adj Close` double, Volume long")
    d = dt.date(2024, 1, 2)
    day1 = spark.createDataFrame([("A", d, 1.0, 2.0, 0.5, 1.5, 1.5, 10)], ddl)
    fix = spark.createDataFrame([("A", d, 1.0, 2.5, 0.5, 2.0, 2.0, 12),
                                 ("A", d + dt.timedelta(days=1), 2.0, 2.0, 2.0, 2.0, 2.0, 1)], ddl)
    day1.write.parquet(f"{tmp_dir}/src/b=0")
    fix.write.parquet(f"{tmp_dir}/src/b=1")
    _order_by_mtime(f"{tmp_dir}/src", ["b=0", "b=1"])
    table = U.ChangeLog(f"{tmp_dir}/table", list(SI.BAR_KEYS))
    for _ in range(2):  # a second run with the same checkpoint finds nothing new
        q = SI.incremental_bars_stream(
            SE.file_stream(spark, f"{tmp_dir}/src/b=*", day1.schema, max_files_per_trigger=1),
            table, f"{tmp_dir}/chk", points_path=f"{tmp_dir}/points")
        q.awaitTermination()
    lines = [r.value for r in spark.read.text(f"{tmp_dir}/points").collect()]
    assert len(lines) == 3 and all(x.startswith("stock_prices,symbol=A ") for x in lines)
    rows = {r.Date: r for r in table.read(spark).collect()}
    assert len(rows) == 2 and rows[d].Close == 2.0 and rows[d].Volume == 12
    assert SI.day_slice(table.read(spark), d).count() == 1


def test_restart_resumes_from_checkpoint(spark, tmp_dir):
    ddl = ("symbol string, Date date, Open double, High double, Low double, Close double, "
           "`Adj Close` double, Volume long")
    d = dt.date(2024, 1, 2)
    spark.createDataFrame([("A", d, 1.0, 1.0, 1.0, 1.0, 1.0, 1)], ddl) \
        .coalesce(1).write.parquet(f"{tmp_dir}/src/b=0")
    schema = spark.read.parquet(f"{tmp_dir}/src/b=0").schema
    table = U.ChangeLog(f"{tmp_dir}/table", list(SI.BAR_KEYS))

    def run():
        q = SI.incremental_bars_stream(SE.file_stream(spark, f"{tmp_dir}/src/b=*", schema),
                                       table, f"{tmp_dir}/chk")
        q.awaitTermination()
        return q.lastProgress["batchId"] if q.lastProgress else None

    run()
    # the next day's file arrives after the first run stopped
    spark.createDataFrame([("A", d + dt.timedelta(days=1), 2.0, 2.0, 2.0, 2.0, 2.0, 2)], ddl) \
        .coalesce(1).write.parquet(f"{tmp_dir}/src/b=1")
    run()
    got = sorted((r.Date, r.Close) for r in table.read(spark).collect())
    assert got == [(d, 1.0), (d + dt.timedelta(days=1), 2.0)]
    import os
    batches = sorted(int(p.split("=")[1]) for p in os.listdir(f"{tmp_dir}/table/changes")
                     if p.startswith("_batch="))
    assert batches == [0, 1]          # the restart processed only the new file


def test_tick_stream_updates_a_bar_across_batches(spark, tmp_dir):
    ddl = ("l_returnflag string, l_shipdate timestamp_ntz, l_orderkey long, l_linenumber int, "
           "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double")
    day = dt.datetime(2024, 1, 2)
    spark.createDataFrame([("A", day, 1, 1, 1, 1, 5.0, 10.0), ("A", day, 2, 1, 1, 1, 5.0, 12.0)],
                          ddl).coalesce(1).write.parquet(f"{tmp_dir}/src/f=0")
    spark.createDataFrame([("A", day, 3, 1, 1, 1, 1.0, 9.0)],
                          ddl).coalesce(1).write.parquet(f"{tmp_dir}/src/f=1")
    _order_by_mtime(f"{tmp_dir}/src", ["f=0", "f=1"])
    schema = spark.read.parquet(f"{tmp_dir}/src/f=0").schema
    log = SC.tick_bar_log(f"{tmp_dir}/table")
    q = SC.tick_bar_stream(
        SE.file_stream(spark, f"{tmp_dir}/src/f=*", schema, max_files_per_trigger=1),
        log, f"{tmp_dir}/chk")
    q.awaitTermination()
    r = SC.read_tick_bars(spark, log).collect()
    assert len(r) == 1
    b = r[0]
    assert (b.Open, b.High, b.Low, b.Close, b.Volume) == (10.0, 12.0, 9.0, 9.0, 11)


def test_word_counts_of_a_replayed_batch_count_once(spark, tmp_dir):
    log = SC.word_log(f"{tmp_dir}/words")
    texts = [spark.createDataFrame([(t,)], "text string") for t in ("a b a", "b c", None)]
    for i, t in enumerate(texts):
        log.write_batch(L.word_count(t), i)
    log.write_batch(L.word_count(texts[1]), 1)          # the batch runs again
    want = {"a": 2, "b": 2, "c": 1}
    assert {r.word: r.n for r in log.read(spark).collect()} == want
    log.compact(spark)
    assert {r.word: r.n for r in log.read(spark).collect()} == want


def test_silence_is_reported_while_other_monitors_beat(spark, tmp_dir):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda h: t0 + dt.timedelta(hours=h)
    rows = [(1, t0, 1, "down", 1.0, "{}"), (2, at(0.5), 1, "down", 1.0, "{}")]
    rows += [(10 + h, at(h), 1, "up", 1.0, "{}") for h in range(8)]
    src = _events(spark, rows)
    sessions = HB.beat_sessions(src, 5400.0)
    assert sorted((r.monitor, r.beats) for r in sessions.collect()) == [("down", 2), ("up", 8)]
    gaps = HB.gaps_of_sessions(sessions, 5400.0).collect()
    assert [(g.monitor, g.gap_seconds) for g in gaps] == [("down", 6.5 * 3600)]
    quiet = HB.silent_now(sessions, at(7), 5400.0).collect()
    assert [(q.monitor, q.silent_seconds) for q in quiet] == [("down", 6.5 * 3600)]
    # the stream writes the session of "down" although it never beats again
    src.coalesce(1).write.parquet(f"{tmp_dir}/src")
    beats = SE.file_stream(spark, f"{tmp_dir}/src", src.schema)
    HB.beat_sessions_stream(beats, f"{tmp_dir}/out", f"{tmp_dir}/chk", 5400.0,
                            "1 hour").awaitTermination()
    closed = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert [(r.monitor, r.beats) for r in closed] == [("down", 2)]
