"""Task failures are retried without changing results (local[N, maxFailures])."""

import os
import subprocess
import sys

from conftest import ROOT, SF_SMOKE

CODE = r"""
import sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, Window, functions as F, types as T
spark = (SparkSession.builder.master("local[4,3]")
         .config("spark.sql.shuffle.partitions", "6")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
         .config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from candlestack.operators import rolling as R
from candlestack.operators.bars import bars_from_ticks
from candlestack.sinks import report as RP
from candlestack.session import scratch_path

@F.udf(T.DoubleType())
def flaky(x):
    # the first attempt of every task fails once: forces a retry everywhere
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return x

ticks = spark.read.parquet({sf!r} + "/lineitem.parquet")
ticks = ticks.withColumn("l_extendedprice", flaky("l_extendedprice"))
bars = bars_from_ticks(ticks)
got = R.rolling_analytics(bars, seg_rows=97)          # sort + write + offsets + segments
w = Window.partitionBy("symbol").orderBy("Date")
f20 = w.rowsBetween(-19, 0)
want = bars.withColumn("MA20", F.when(F.count("Close").over(f20) == 20,
                                      F.avg("Close").over(f20)))
cols = ["symbol", "Date", "MA20"]
diff = got.select(*cols).exceptAll(want.select(*cols)).count()
tally = RP.send_in_batches(bars.withColumn("_index", F.lit("b")),
                           RP.JsonLinesWriter(scratch_path(spark, "retry")), batch_size=100).collect()
print("RESULT", got.count(), want.count(), diff, tally[0].written)
"""


def test_results_survive_task_retries():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, sf=SF_SMOKE)],
                         env=env, capture_output=True, text=True, timeout=900)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-3000:]
    _, n_got, n_want, diff, written = line[0].split()
    assert n_got == n_want and diff == "0" and int(written) == int(n_want)
