"""bench.py prints exactly one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMOKE


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMOKE, BENCH_CPUS="2",
               BENCH_QUERIES="bars_daily,period_stats_long,word_count")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["metric"]
    assert set(rec["queries"]) == {"bars_daily", "period_stats_long", "word_count"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)


def test_cli_lists_and_runs(tmp_path):
    env = dict(os.environ)
    out = subprocess.run([sys.executable, "-m", "candlestack", "list"], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=300, check=True).stdout
    assert "period_stats_long" in out.split()
    dest = str(tmp_path / "monthly")
    subprocess.run([sys.executable, "-m", "candlestack", "run", "monthly_stats",
                    "--sf-dir", SF_SMOKE, "--out", dest, "--master", "2"], cwd=ROOT, env=env,
                   capture_output=True, text=True, timeout=600, check=True)
    assert any(f.endswith(".parquet") for f in os.listdir(dest))


def test_example_daily_flow_runs(tmp_path):
    out = subprocess.run([sys.executable, os.path.join(ROOT, "examples", "daily_flow.py"),
                          SF_SMOKE], cwd=str(tmp_path), capture_output=True, text=True,
                         timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("bars ")]
    assert line, out.stderr[-2000:]
    assert line[0].split()[1:4] == ["4139", "corrupt", "0"]
