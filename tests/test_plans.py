"""Plan shape of every registered query: JVM-side operators only, pruned scans."""

import pytest

from dfinsight.plans import catalog as entry
from dfinsight.operators.profile import numeric_summary
from tests.conftest import SF001, plan_of

# Queries whose builders run a stream or write files first; the plans they run are checked in test_executed_plans.
SIDE_EFFECTS = {"stream_counts_events", "stream_latest_events", "stream_dedupe_events", "metric_series_day",
                "stream_counts_restarted", "stream_latest_restarted", "stream_dedupe_batches", "metric_series_restarted",
                "metric_latest_stream", "csv_with_bom_titles", "csv_roundtrip_titles", "word_count_lines", "classifier_train_embeddings",
                "csv_split_titles", "csv_split_documents", "landed_audit_titles", "landed_clean_titles",
                "sgd_first_steps_embeddings", "sgd_ranks_embeddings", "stream_counts_expiring",
                "word_top_threshold"}
# MapInArrow: per-task X^T X; sorted partitions integrated as they stream by; products of bitmaps
ARROW_BATCHED = {"gram_matrix", "integral_user", "user_activity_events", "label_overlaps_titles", "matmul_tiled_gram"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SIDE_EFFECTS))
def test_no_row_at_a_time_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF001))
    assert "BatchEvalPython" not in plan and "PythonUDF" not in plan
    if name not in ARROW_BATCHED:
        assert "MapInPandas" not in plan and "MapInArrow" not in plan and "ArrowEvalPython" not in plan


def test_numeric_summary_single_scan(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    plan = plan_of(numeric_summary(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
    assert plan.count("FileScan parquet") == 1
    assert "l_returnflag" not in plan  # pruned to the four columns


def test_gram_matrix_shuffles_only_partials(spark):
    plan = plan_of(entry.queries()["gram_matrix"](spark, SF001))
    assert "MapInArrow" in plan and "hashpartitioning(i" in plan


def _windows(node):
    """(partition key count) of every Window node in a physical plan, AQE wrappers unwrapped."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _windows(node.executedPlan())
        return
    if name == "Window":
        yield node.partitionSpec().size()
    kids = node.children()
    for i in range(kids.size()):
        yield from _windows(kids.apply(i))


# Unpartitioned windows allowed only over bounded inputs: one row per time bucket (trend deltas),
# per range partition (sequence offsets, range proofs).
BOUNDED_GLOBAL_WINDOWS = {"trend_delta_orders": 1, "trend_day_events": 1, "global_sequence_events": 1,
                          "sorted_ranges_check": 1, "epoch_shards_embeddings": 2, "integral_windows_user": 1,
                          "integral_windows_whole": 1, "metric_series_filled": 2}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SIDE_EFFECTS))
def test_no_unpartitioned_window_over_data(spark, name):
    plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan()
    unpartitioned = sum(1 for n in _windows(plan) if n == 0)
    assert unpartitioned == BOUNDED_GLOBAL_WINDOWS.get(name, 0)


def _node_names(node):
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _node_names(node.executedPlan())
        return
    yield name
    kids = node.children()
    for i in range(kids.size()):
        yield from _node_names(kids.apply(i))


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SIDE_EFFECTS))
def test_no_cross_join(spark, name):
    names = set(_node_names(entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan()))
    assert not names & {"CartesianProduct", "BroadcastNestedLoopJoin"}


# Every broadcast is of a table with a proven bound: one row per range partition (global_sequence,
# epoch_shards, running_count), or a side Catalyst sized from file statistics under the broadcast
# threshold (at this scale: matmul's part table, the top keys of a label, carried counts).
BOUNDED_BROADCASTS = {"rank_variants_genre": 1, "top_per_genre": 1, "running_count_user": 2,
                      "user_activity_events": 2, "global_sequence_events": 1,
                      "epoch_shards_embeddings": 2, "matmul_order_size": 1,
                      "schema_report_orders": 1,  # one row per column of the table
                      "integral_windows_user": 1, "integral_windows_whole": 1, "metric_series_filled": 3,  # one row per range partition
                      "label_overlaps_titles": 2, "matmul_tiled_gram": 1}  # one row per label; tiles of one side, sized by Catalyst


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SIDE_EFFECTS))
def test_broadcasts_only_bounded_tables(spark, name):
    names = list(_node_names(entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan()))
    assert names.count("BroadcastExchange") == BOUNDED_BROADCASTS.get(name, 0)
