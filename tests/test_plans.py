"""What the physical plans of the queries must and must not hold."""

import re

import pytest
from conftest import plan

from brightmere.plans import QUERIES

FOLDER = "/root/testdata/sf0.001"
JVM_ONLY = """standardize_good parking_load scd1_upsert scd1_composite fact_star join_chain graph_two_hop dedupe_key
latest_per_key demand_hourly training_frame minmax_scale anonymize dq_suite dq_constraints obs_task_p90
obs_event_counts obs_metric_ratio obs_counter_delta quantiles_by_bin dcount_by_bin parse_kv reingest_plan""".split()


@pytest.mark.parametrize("name", JVM_ONLY)
def test_no_python_and_no_pairs(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for part in ("EvalPython", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert part not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["scan_parquet"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", text)
    assert "l_comment" not in text and "l_tax" not in text


def test_a_month_reads_its_partition(spark):
    text = plan(QUERIES["partition_view"](spark, FOLDER))
    assert re.search(r"PartitionFilters: \[.*year.*1997.*month.*5", text)


@pytest.mark.parametrize("name", ["dedupe_key", "latest_per_key", "standardize_good"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


@pytest.mark.parametrize("name", ["topk", "limit_rows"])
def test_top_rows_do_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, FOLDER))


def test_a_suite_reads_once(spark):
    text = plan(QUERIES["dq_suite"](spark, FOLDER))
    assert text.count("Scan") == 1


def test_only_the_wanted_events_are_read(spark):
    """A family that needs only tasks does not read the sources of other events."""
    text = plan(QUERIES["obs_host_sum"](spark, FOLDER))
    assert "lineitem.parquet" in text and "orders.parquet" not in text and "events.parquet" not in text


def test_unbounded_results_are_not_sorted_in_one_task(spark):
    text = plan(QUERIES["sort_multi"](spark, FOLDER))
    assert "rangepartitioning" in text and "SinglePartition" not in text


def test_demand_of_hours_without_weather(spark, tmp_path):
    """Each hour has a value above the weather's, so no hour is left to learn from or to score."""
    events = "SELECT id AS event_id, TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, id) AS ts, id AS user_id, 'view' AS event_type, 250D AS value, '{\"k\": 1}' AS props FROM range(9)"
    parts = "SELECT id AS p_partkey, 'x' AS p_name, 'Brand#2' AS p_brand, 'ECONOMY' AS p_type, 1 AS p_size, 1D AS p_retailprice FROM range(9)"
    spark.sql(events).write.parquet(f"{tmp_path}/events.parquet")
    spark.sql(parts).write.parquet(f"{tmp_path}/part.parquet")
    scored = QUERIES["score_demand"](spark, str(tmp_path))
    assert scored.columns[-2:] == ["demand", "positive"] and scored.collect() == []
    trained = QUERIES["train_demand"](spark, str(tmp_path)).select("family", "rows", "mae", "r2")
    assert sorted(map(tuple, trained.collect())) == [("gbt", 0, None, None), ("poisson", 0, None, None)]
