"""Sales KPIs. Revenue is the sum of item prices, without freight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import mean_of_rounded, money_sum, month_of, report_round
from ordermill.plans.warehouse import by_order


def _revenue(revenue: str, average: str = "average_order_value") -> list[Column]:
    return [
        money_sum("order_total_price").alias(revenue),
        mean_of_rounded("order_total_price", 2).alias(average),
    ]


def overall_sales_kpis(tables) -> DataFrame:
    return tables.delivery_features.agg(
        F.count("order_id").alias("total_orders"),
        *_revenue("total_revenue"),
        report_round(F.min("order_total_price")).alias("minimum_order_value"),
        report_round(F.max("order_total_price")).alias("maximum_order_value"),
    )


def monthly_sales_performance(tables) -> DataFrame:
    months = by_order(tables, "fact_orders").select("order_id", month_of("order_purchase_timestamp").alias("month"))
    return (
        by_order(tables, "delivery_features").select("order_id", "order_total_price")
        .join(months, "order_id")
        .groupBy("month")
        .agg(F.count("order_id").alias("orders"), *_revenue("revenue"))
        .orderBy(F.asc_nulls_last("month"))
    )


def sales_by_order_status(tables) -> DataFrame:
    return (
        tables.delivery_features.groupBy("order_status")
        .agg(F.count("order_id").alias("total_orders"), *_revenue("total_revenue"))
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("order_status"))
    )


def late_orders_impact_on_sales(tables) -> DataFrame:
    """On time, late, and (last) outcome unknown."""
    return (
        tables.delivery_features.groupBy("is_late")
        .agg(F.count("order_id").alias("total_orders"), *_revenue("total_revenue"))
        .orderBy(F.asc_nulls_last("is_late"))
    )


QUERIES = {
    "overall_sales_kpis": overall_sales_kpis,
    "monthly_sales_performance": monthly_sales_performance,
    "sales_by_order_status": sales_by_order_status,
    "late_orders_impact_on_sales": late_orders_impact_on_sales,
}
