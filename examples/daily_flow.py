"""End-to-end daily flow, as a user of the library runs it.

Bars arrive as CSV files per symbol; they are split-adjusted, enriched,
summarised by month / quarter / year, and rendered as keyed documents and
line-protocol points.  Everything stays distributed; outputs are written
under the session's checkpoint folder.

    python examples/daily_flow.py [/root/testdata/sf0.01]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlestack.operators import bars as B  # noqa: E402
from candlestack.operators import periods as P  # noqa: E402
from candlestack.operators import rolling as R  # noqa: E402
from candlestack.plans.queries import bars as driver_bars  # noqa: E402
from candlestack.session import local_session, scratch_path  # noqa: E402
from candlestack.sinks import documents as D  # noqa: E402
from candlestack.sinks import landing as LD  # noqa: E402
from candlestack.sinks import points as PT  # noqa: E402
from candlestack.sources import csv as CSV  # noqa: E402


def main(sf_dir: str) -> None:
    spark = local_session(8)
    root = scratch_path(spark, "daily-flow")

    # 1. bar files per symbol (here landed from the driver's ticks)
    LD.land_csv(driver_bars(spark, sf_dir), f"{root}/csv", partition_by=["symbol"])

    # 2. read them back as typed bars, keep corrupt lines aside
    good, bad = CSV.split_corrupt(CSV.read_bar_csv(spark, f"{root}/csv"))

    # 3. split adjust and derived columns, rolling analytics
    bars = B.derived_columns(B.split_adjust(good, 20))
    rolled = R.rolling_analytics(bars.drop("Return", "AVG Price", "Close Pct Change"))

    # 4. period statistics, one scan for the three levels
    stats = P.period_stats_long(bars)

    # 5. render and write: documents per level, points per bar
    D.write_documents(D.stats_documents(stats), f"{root}/documents")
    PT.write_points(PT.bar_points(bars), f"{root}/points", mode="overwrite")
    LD.land(rolled, f"{root}/rolled")

    print("bars", bars.count(), "corrupt", bad.count(), "stats", stats.count(),
          "output", root)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
