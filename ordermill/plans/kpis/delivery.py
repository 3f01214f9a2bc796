"""Delivery KPIs. Orders are unique in ``fact_orders`` and ``delivery_features``, so they are counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import days_between, month_of, report_round, share

MIN_PRIOR_ORDERS = 20
TOP = 20


def days_late() -> Column:
    """Days past the estimate; early and undelivered orders count as 0."""
    return F.when(F.col("delivery_delay_days") > 0, F.col("delivery_delay_days")).otherwise(0)


def overall_delivery_kpis(tables) -> DataFrame:
    """Late rate over *all* orders, known outcome or not.

    The estimated duration is a function of two ``fact_orders`` columns, and the feature table has
    the same orders, so no join is needed to average it.
    """
    orders = F.count("order_id")
    late = F.coalesce(F.sum(F.when(F.col("is_late") == 1, 1).otherwise(0)), F.lit(0))
    estimated = days_between("order_estimated_delivery_date", "order_purchase_timestamp")
    return tables.fact_orders.filter(F.col("order_id").isNotNull()).agg(
        orders.alias("total_orders"),
        report_round(F.avg(estimated)).alias("avg_estimated_delivery_days"),
        report_round(F.avg("delivery_duration_days")).alias("avg_actual_delivery_days"),
        report_round(F.avg(days_late())).alias("avg_delivery_delay_days"),
        report_round(share(late * 100, orders)).alias("late_delivery_rate"),
    )


def delivery_performance_by_month(tables) -> DataFrame:
    """Late rate over orders with a *known* outcome."""
    return (
        tables.fact_orders.groupBy(month_of("order_purchase_timestamp").alias("month"))
        .agg(
            F.count("order_id").alias("orders"),
            report_round(F.avg("delivery_duration_days")).alias("avg_delivery_days"),
            report_round(F.avg(days_late())).alias("avg_delay_days"),
            report_round(F.avg("is_late") * 100).alias("late_rate_percentage"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def late_deliveries_by_seller(tables) -> DataFrame:
    """Peaks of the running history per seller, so one order short of the seller's full record."""
    return (
        tables.seller_performance.groupBy("seller_id")
        .agg(
            F.max("seller_order_count").alias("orders"),
            F.max("seller_late_order_count").alias("late_orders"),
            report_round(F.max("seller_late_rate") * 100).alias("late_rate_percentage"),
            report_round(F.max("seller_avg_delivery_delay_days")).alias("avg_delivery_delay_days"),
        )
        .filter(F.col("orders") >= MIN_PRIOR_ORDERS)
        .orderBy(F.desc_nulls_last("late_rate_percentage"), F.asc_nulls_last("seller_id"))
        .limit(TOP)
    )


def delivery_performance_by_order_status(tables) -> DataFrame:
    delivered = F.col("order_status") == "delivered"
    return (
        tables.fact_orders.groupBy("order_status")
        .agg(
            F.count("order_id").alias("orders"),
            report_round(F.avg(F.when(delivered, F.col("delivery_duration_days")))).alias("avg_delivery_days"),
            # greatest() skips NULLs: a delivered order without a delivery date counts as 0 days late.
            report_round(F.avg(F.when(delivered, F.greatest("delivery_delay_days", F.lit(0))))).alias(
                "avg_delay_days"
            ),
        )
        .orderBy(F.desc_nulls_last("orders"), F.asc_nulls_last("order_status"))
    )


def late_delivery_by_purchase_day(tables) -> DataFrame:
    """Day of the week with Sunday = 1."""
    return (
        tables.delivery_features.groupBy("purchase_day_of_week")
        .agg(
            F.count("order_id").alias("orders"),
            report_round(F.avg("is_late") * 100).alias("late_rate_percentage"),
        )
        .orderBy(F.asc_nulls_last("purchase_day_of_week"))
    )


QUERIES = {
    "overall_delivery_kpis": overall_delivery_kpis,
    "delivery_performance_by_month": delivery_performance_by_month,
    "late_deliveries_by_seller": late_deliveries_by_seller,
    "delivery_performance_by_order_status": delivery_performance_by_order_status,
    "late_delivery_by_purchase_day": late_delivery_by_purchase_day,
}
