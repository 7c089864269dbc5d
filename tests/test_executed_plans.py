"""Guards over every plan a registered query really runs, also those behind stored layouts and streams,
read from the event log of one run over all queries."""

import glob
import json
import os
import re
import subprocess
import sys
import tempfile
from collections import Counter, defaultdict

import pytest

from dfinsight.plans import catalog
from tests.conftest import SF001

RUN = """
import sys
from dfinsight.plans import catalog
from dfinsight.session import build_session
spark = build_session("local[4]", 8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": sys.argv[1],
                                            "spark.sql.maxPlanStringLength": "4000000", "spark.eventLog.rolling.enabled": "false",
                                            "spark.eventLog.compress": "false"})
for name, q in catalog.queries().items():
    spark.sparkContext.setJobGroup(name, name)
    q(spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
spark.stop()
"""
# Windows without a partition key are allowed over one row per time bucket or per range partition.
BOUNDED_WINDOWS = {"trend_delta_orders", "trend_day_events", "global_sequence_events", "sorted_ranges_orders",
                   "sorted_ranges_check", "epoch_shards_embeddings", "integral_windows_user", "integral_windows_whole", "metric_series_filled",
                   "sgd_first_steps_embeddings", "sgd_ranks_embeddings"}


def _groups(args: str) -> list[str]:
    """Top-level [...] groups of a node's argument text."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(args):
        if ch == "[":
            if depth == 0:
                start = i
            depth += 1
        elif ch == "]":
            depth -= 1
            if depth == 0:
                out.append(args[start:i + 1])
    return out


def _unpartitioned_windows(plan: str) -> int:
    n = 0
    for args in re.findall(r"^\(\d+\) Window\b[^\n]*\n(?:Input[^\n]*\n)?Arguments: ([^\n]*)", plan, re.M):
        lists = _groups(args)
        n += len(lists) == 1 or len(lists) == 2 and bool(re.search(r" (ASC|DESC) NULLS ", lists[1]))
    return n


@pytest.fixture(scope="module")
def executed():
    """query -> texts of all physical plans that ran for it."""
    log = tempfile.mkdtemp(prefix="dfinsight-events-")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", RUN, log, SF001], check=True, timeout=900, capture_output=True,
                   cwd=root, env=dict(os.environ, PYTHONPATH=root))
    plans, group = defaultdict(dict), None
    for path in (p for p in glob.glob(f"{log}/**", recursive=True) if os.path.isfile(p)):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev["Event"].rsplit(".", 1)[-1]
                if kind == "SparkListenerSQLExecutionStart":
                    # a stream's batches run under groups of their own: they belong to the query before
                    named = [x for x in (ev.get("jobGroupId"), ev.get("description")) if x in catalog.queries()]
                    group = named[0] if named else group
                    plans[group][ev["executionId"]] = [ev["physicalPlanDescription"]]
                elif kind == "SparkListenerSQLAdaptiveExecutionUpdate":
                    for by_id in plans.values():
                        if ev["executionId"] in by_id:
                            by_id[ev["executionId"]].append(ev["physicalPlanDescription"])
    return {g: [p for texts in by_id.values() for p in texts] for g, by_id in plans.items()}


def test_every_query_left_plans(executed):
    assert set(catalog.queries()) <= set(executed)


def test_no_cross_join_ran(executed):
    bad = Counter(g for g, texts in executed.items() for p in texts if re.search(r"CartesianProduct|BroadcastNestedLoopJoin", p))
    assert not bad


def test_no_row_at_a_time_python_ran(executed):
    assert not Counter(g for g, texts in executed.items() for p in texts if "BatchEvalPython" in p)


def test_no_unpartitioned_window_over_data_ran(executed):
    found = {g for g, texts in executed.items() if any(_unpartitioned_windows(p) for p in texts)}
    assert found <= BOUNDED_WINDOWS
    assert found  # the parser sees the bounded ones
