"""Star schema: dimensions and facts from the cleaned tables.

Dimension keys are already unique after cleaning, so no second deduplication is planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ordermill.functions.columns import days_between, late_if_known
from ordermill.operators.clean import ORDER_TIMES, PRODUCT_MEASURES


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_category_name", *PRODUCT_MEASURES)


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def fact_orders(orders: DataFrame) -> DataFrame:
    """One row per order; the late flag stays NULL while the outcome is unknown."""
    return (
        orders.withColumns(
            {
                "delivery_duration_days": days_between("order_delivered_customer_date", "order_purchase_timestamp"),
                "delivery_delay_days": days_between("order_delivered_customer_date", "order_estimated_delivery_date"),
            }
        )
        .withColumn("is_late", late_if_known("delivery_delay_days"))
        .select(
            "order_id",
            "customer_id",
            "order_status",
            *ORDER_TIMES,
            "delivery_duration_days",
            "delivery_delay_days",
            "is_late",
        )
    )


def fact_order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Every item with its order's customer, status and times; items of unknown orders are kept."""
    order_columns = orders.select("order_id", "customer_id", "order_status", *ORDER_TIMES)
    return items.join(order_columns, "order_id", "left").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "customer_id",
        "order_status",
        "shipping_limit_date",
        "price",
        "freight_value",
        "total_item_value",
        *ORDER_TIMES,
    )


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )
