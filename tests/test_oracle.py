"""Every registered query against its SQL statement, and the shape of the plans that matter at scale."""

import pytest

import __spark_entry__ as contract
from oracle.queries import ORACLE
from oracle_check import connect, differences
from ordermill.catalog import QUERIES

WITHOUT_SQL = {"risk_scores", "risk_coefficients", "risk_coefficients_with_indicators", "risk_evaluation"}


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, tiny, duck, name):
    assert differences(QUERIES[name](spark, tiny), duck, ORACLE[name]) == []


def test_only_iterative_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(QUERIES) <= set(contract.queries()) and ORACLE.items() <= contract.oracle_sql().items()


def test_flagship(spark):
    assert contract.entry(spark).columns == [
        "seller_id", "total_orders", "late_orders", "late_rate_percentage", "average_delivery_delay_days",
    ]


def physical_plan(spark, tiny, name):
    """The plan for big tables: nothing small enough to broadcast, no runtime re-planning."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        return QUERIES[name](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - {"delay_describe", "timeline_describe", "imputed_features"}))
def test_no_cross_joins_and_no_python(spark, tiny, name):
    plan = physical_plan(spark, tiny, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize(
    "name",
    ["top_products_by_revenue", "top_sellers_by_orders", "worst_sellers_by_late_rate", "late_deliveries_by_seller",
     "seller_ranking_full_history", "seller_history_preview"],
)
def test_top_k_is_not_a_full_sort(spark, tiny, name):
    assert "TakeOrderedAndProject" in physical_plan(spark, tiny, name)


def test_history_sorts_the_pairs_once(spark, tiny):
    plan = physical_plan(spark, tiny, "seller_performance")
    # One window over the pairs, one over the totals of blocks and one over those of super-blocks.
    assert plan.count("- Window [") == 3
    # The long side of the last join is the window itself: no exchange between them.
    top = plan.splitlines()[1:8]
    assert "SortMergeJoin" in top[0] and "Window [" in top[2]
    assert not any("Exchange" in line for line in top[:4])


def test_pairs_of_the_history_are_dealt_once_after_the_join_with_orders(spark, tiny):
    lines = physical_plan(spark, tiny, "seller_performance").splitlines()
    window = next(i for i, line in enumerate(lines) if "- Window [" in line)
    join = next(i for i, line in enumerate(lines) if i > window and "SortMergeJoin [order_id" in line)
    dealt = [line for line in lines[window:join] if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and "_block" in dealt[0]


def test_category_report_has_no_expand(spark, tiny):
    assert "Expand" not in physical_plan(spark, tiny, "revenue_by_product_category")


@pytest.mark.parametrize("name", ["overall_sales_kpis", "sales_by_order_status", "customers_by_number_of_orders"])
def test_unused_seller_history_is_not_computed(spark, tiny, name):
    assert "Window" not in physical_plan(spark, tiny, name)


def test_one_pass_per_quality_suite(spark, tiny):
    plan = physical_plan(spark, tiny, "quality_order_items")
    assert plan.count("FileScan") == 1
    assert physical_plan(spark, tiny, "quality_payments").count("FileScan") == 1


def test_reports_on_a_stored_layer_read_only_their_columns(spark, tiny, tmp_path):
    from ordermill.plans.kpis.reviews import overall_review_kpis
    from ordermill.plans.warehouse import StoredWarehouse
    from ordermill.sources.files import write_table

    write_table(QUERIES["fact_reviews"](spark, tiny), str(tmp_path / "fact_reviews"))
    plan = overall_review_kpis(StoredWarehouse(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<review_score:int>" in plan


def test_filters_reach_the_scan(spark, tiny):
    plan = physical_plan(spark, tiny, "overall_product_kpis")
    assert "PushedFilters: [IsNotNull(l_extendedprice)" in plan
    assert "GreaterThanOrEqual(l_extendedprice,0.0)" in plan


def test_texts_that_a_report_does_not_read_are_not_shuffled(spark, tiny):
    lines = physical_plan(spark, tiny, "overall_review_kpis").splitlines()
    moved = [line for line in lines if "Aggregate" in line or "Exchange" in line]
    assert moved and not any("props" in line or "comment" in line for line in moved)
