"""Plans: what reaches the scan, and what must not be in them."""

import pytest

from __spark_entry__ import queries
from millrace.catalog.registry import table
from millrace.operators import aggregates as a
from millrace.operators import windows as w


def plan(df):
    return df._jdf.queryExecution().toString()


def test_columns_and_filters_reach_the_scan(spark, sf):
    df = table(spark, sf, "orders").where("o_totalprice > 1000").groupBy("o_orderstatus").count()
    text = plan(df)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in text
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in text


@pytest.mark.parametrize("name", [
    "agg_1_cost_breakdown", "agg_15_confusion_matrix", "jon_6_replication_lag", "jon_8_missing_copies", "tsq_8_absent",
    "jon_4_interval_promotion", "vec_1_exact_top_k", "drf_1_ks_statistic", "fea_6_standard_scale",
])
def test_no_cross_joins(spark, sf, name):
    text = plan(queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_latest_row_is_a_partial_aggregate(spark, sf):
    text = plan(w.latest(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey"]))
    assert "partial_max_by" in text and "Window" not in text.split("Physical Plan")[1]


def test_newest_rows_are_limited_before_the_shuffle(spark, sf):
    text = plan(w.newest(table(spark, sf, "events"), "event_type", ["ts", "event_id"], 1000))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_duplicates_shuffle_digests_only(spark, sf):
    text = plan(a.duplicate_rows(table(spark, sf, "documents"), ["lang", "source", "text"]))
    # the digest is computed ahead of the exchange and is its key
    assert "hashpartitioning(_groupingexpression" in text and "hashpartitioning(text" not in text


def test_no_python_in_the_metric_plans(spark, sf):
    for name in ("tsq_1_rate", "tsq_4_histogram_quantile", "agg_16_classification_report", "win_9_retention", "jon_4_interval_promotion"):
        text = plan(queries()[name](spark, sf))
        assert "Python" not in text and "InPandas" not in text, name


def test_checkpoint_folder_comes_from_the_session(spark):
    from millrace.session import shared_dir

    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
