"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR=SF_SMALL,
        BENCH_CPUS="2",
        BENCH_RUNS="1",
        BENCH_QUERIES="funnel_summary,calendar_enrich",
    )
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=600,
        cwd=ROOT,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [x for x in proc.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"funnel_summary", "calendar_enrich"}
    assert result["failed"] == {}
