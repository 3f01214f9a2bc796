"""Product KPIs. Product revenue includes freight, unlike the revenue of the sales KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import amount, money, money_avg, money_mean, money_sum, report_round, share

TOP = 20


def _categories(tables) -> DataFrame:
    return tables.dim_products.select(
        "product_id", F.coalesce("product_category_name", F.lit("Unknown")).alias("category")
    )


def overall_product_kpis(tables) -> DataFrame:
    return tables.fact_order_items.agg(
        F.countDistinct("product_id").alias("total_products"),
        money_mean(F.sum(amount("price")), F.count(amount("price"))).alias("average_product_price"),
        money_sum("total_item_value").alias("total_product_revenue"),
        money_sum("freight_value").alias("total_freight_revenue"),
    )


def top_products_by_revenue(tables) -> DataFrame:
    return (
        tables.fact_order_items.groupBy("product_id")
        .agg(
            F.countDistinct("order_id").alias("orders"),
            money_sum("total_item_value").alias("revenue"),
            money_avg("price").alias("average_price"),
        )
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("product_id"))
        .limit(TOP)
    )


def revenue_by_product_category(tables) -> DataFrame:
    """Sums per product join the category as one row each; distinct orders of a category are counted apart."""
    items = tables.fact_order_items.filter(F.col("product_id").isNotNull())
    sold = items.groupBy("product_id").agg(
        F.sum(amount("total_item_value")).alias("value"),
        F.sum(amount("price")).alias("prices"),
        F.count(amount("price")).alias("priced"),
    )
    categories = _categories(tables)
    totals = (
        sold.join(categories, "product_id")
        .groupBy("category")
        .agg(
            F.count("product_id").alias("products"),
            money(F.sum("value")).alias("revenue"),
            money_mean(F.sum("prices"), F.sum("priced")).alias("average_price"),
        )
    )
    bought = items.select("product_id", "order_id").distinct().join(categories, "product_id")
    orders = bought.groupBy("category").agg(F.countDistinct("order_id").alias("orders"))
    return (
        totals.join(orders, "category")
        .select("category", "orders", "products", "revenue", "average_price")
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("category"))
    )


def freight_performance_by_category(tables) -> DataFrame:
    """Summed per product before the join, so a bestseller reaches the join as one row."""
    sold = tables.fact_order_items.groupBy("product_id").agg(
        F.sum(amount("freight_value")).alias("freight"),
        F.count(amount("freight_value")).alias("freights"),
        F.sum(amount("total_item_value")).alias("value"),
    )
    return (
        sold.join(_categories(tables), "product_id")
        .groupBy("category")
        .agg(
            money_mean(F.sum("freight"), F.sum("freights")).alias("average_freight"),
            report_round(share(F.sum("freight"), F.sum("value")) * 100).alias(
                "freight_percentage"
            ),
        )
        .orderBy(F.desc_nulls_last("freight_percentage"), F.asc_nulls_last("category"))
    )


QUERIES = {
    "overall_product_kpis": overall_product_kpis,
    "top_products_by_revenue": top_products_by_revenue,
    "revenue_by_product_category": revenue_by_product_category,
    "freight_performance_by_category": freight_performance_by_category,
}
