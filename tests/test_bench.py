import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1", BENCH_SCALING="0", BENCH_OTHERS="0.01",
               BENCH_QUERIES="country_report,word_count_top")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, check=True, timeout=600).stdout.strip().splitlines()
    assert len(out) == 1
    res = json.loads(out[0])
    assert res["unit"] == "sec" and res["sf"] == 0.001
    assert set(res["queries"]) == {"country_report", "word_count_top"}
    assert abs(res["value"] - sum(res["queries"].values())) < 1e-3
    # the first of the others starts within its time, the rest is named
    assert len(res["others"]) >= 1 and res["not_timed"] and not set(res["others"]) & set(res["queries"])
