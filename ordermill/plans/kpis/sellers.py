"""Seller KPIs over the running history.

``total_orders`` is the largest number of *earlier* orders, so one less than the seller's orders, and
the late rate is the *peak* of the running rate, not the final one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import mean_of_rounded, report_round
from ordermill.plans.kpis.delivery import MIN_PRIOR_ORDERS, TOP


def _per_seller(tables) -> DataFrame:
    return tables.seller_performance.groupBy("seller_id").agg(
        F.max("seller_order_count").alias("total_orders"),
        F.max("seller_late_order_count").alias("late_orders"),
        report_round(F.max("seller_late_rate") * 100).alias("late_rate_percentage"),
        mean_of_rounded("seller_avg_delivery_delay_days", 2).alias("average_delivery_delay_days"),
    )


def overall_seller_kpis(tables) -> DataFrame:
    return tables.seller_performance.agg(
        F.countDistinct("seller_id").alias("total_sellers"),
        F.countDistinct("order_id").alias("total_orders"),
    )


def top_sellers_by_orders(tables) -> DataFrame:
    return (
        _per_seller(tables)
        .orderBy(F.desc_nulls_last("total_orders"), F.asc_nulls_last("seller_id"))
        .limit(TOP)
    )


def worst_sellers_by_late_rate(tables) -> DataFrame:
    return (
        _per_seller(tables)
        .filter(F.col("total_orders") >= MIN_PRIOR_ORDERS)
        .orderBy(F.desc_nulls_last("late_rate_percentage"), F.asc_nulls_last("seller_id"))
        .limit(TOP)
    )


def seller_performance_distribution(tables) -> DataFrame:
    """A seller without a rate (no earlier order with a known outcome) falls into the last bucket."""
    rate = F.max("seller_late_rate")
    bucket = (
        F.when(rate < 0.10, "Excellent (<10%)")
        .when(rate < 0.20, "Good (10-20%)")
        .when(rate < 0.30, "Average (20-30%)")
        .otherwise("Poor (30%+)")
    )
    return (
        tables.seller_performance.groupBy("seller_id")
        .agg(bucket.alias("seller_performance"))
        .groupBy("seller_performance")
        .agg(F.count(F.lit(1)).alias("sellers"))
        .orderBy("seller_performance")
    )


QUERIES = {
    "overall_seller_kpis": overall_seller_kpis,
    "top_sellers_by_orders": top_sellers_by_orders,
    "worst_sellers_by_late_rate": worst_sellers_by_late_rate,
    "seller_performance_distribution": seller_performance_distribution,
}
