"""Physical-plan checks: pushdown, pruning, partial aggregation, no Python in the hot path."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL

from adfuse.operators import conform_all, filter_fact
from adfuse.plans.catalog import QUERIES
from adfuse.sources import CHANNELS
from adfuse.sources.lineitem_feeds import raw_feeds


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_no_cartesian(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad} in plan"


def test_channels_of_one_table_are_one_scan(spark):
    p = plan(QUERIES["unified_fact"](spark, SF_SMALL))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1 and "Union" not in p
    assert "In(l_returnflag, [A,N,R])" in p


def test_a_choice_of_platforms_reaches_the_scan_as_tags(spark):
    p = plan(QUERIES["filter_platforms"](spark, SF_SMALL))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1
    assert "In(l_returnflag, [N,R])" in p


def test_platform_filter_prunes_union_branches(spark):
    fact = conform_all(raw_feeds(spark, SF_SMALL), CHANNELS)
    p = plan(filter_fact(fact, platforms=["Google", "TikTok"]))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 2
    assert "EqualTo(l_returnflag,A)" not in p


def test_date_filter_reaches_scan(spark):
    p = plan(QUERIES["filter_dates"](spark, SF_SMALL))
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters")]
    assert pushed and all("l_shipdate" in line for line in pushed)


def test_column_pruning_reaches_scan(spark):
    p = plan(QUERIES["video_funnel"](spark, SF_SMALL))
    schema = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert len(schema) == 1
    for unused in ("l_discount", "l_tax", "l_linestatus", "l_linenumber", "l_shipdate"):
        assert unused not in schema[0]


def test_rollup_has_partial_and_final_aggregation(spark):
    p = plan(QUERIES["campaign_rollup"](spark, SF_SMALL))
    assert "partial_sum" in p and len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1


def test_share_uses_scalar_subquery_not_single_partition_window(spark):
    p = plan(QUERIES["spend_share"](spark, SF_SMALL))
    assert "Subquery" in p and "Window" not in p and "Join" not in p


def test_best_worst_is_one_aggregate_without_sort(spark):
    p = plan(QUERIES["best_worst_campaign"](spark, SF_SMALL))
    assert "min_by" in p and "Sort " not in p and "Window" not in p


def test_the_stored_fact_is_dealt_out_without_one_task_for_a_month(spark):
    """Rebalanced, which adaptive execution can split; not repartitioned by platform and month."""
    fact = QUERIES["unified_fact"](spark, SF_SMALL).selectExpr("*", "year(date) * 100 + month(date) AS m")
    p = plan(fact.hint("rebalance", "platform", "m").sortWithinPartitions("platform", "m", "campaign_name", "date"))
    assert "REBALANCE_PARTITIONS_BY_COL" in p and "REPARTITION_BY_COL" not in p


@pytest.mark.parametrize("name", ["filtered_campaign_rollup", "filtered_kpis"])
def test_one_off_filter_reaches_the_scans(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters")]
    assert len(pushed) == 1 and "l_shipdate" in pushed[0] and "In(l_returnflag, [N,R])" in pushed[0]
