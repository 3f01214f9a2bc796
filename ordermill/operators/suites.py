"""The check suites of the cleaned tables and of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import amount
from ordermill.operators.quality import (
    Rule,
    allowed,
    at_least,
    between,
    non_negative,
    not_null,
    required_columns,
    rule,
    run_checks,
    same_value,
    unique,
)

# Which checks each table must pass, with their bounds.
SILVER_SUITES: dict[str, list[Rule]] = {
    "customers": [
        unique(["customer_id"], "duplicate_customer_ids"),
        not_null("customer_id", "null_customer_ids"),
        non_negative("customer_zip_code_prefix", "invalid_zip_prefixes"),
    ],
    "sellers": [
        unique(["seller_id"], "duplicate_seller_ids"),
        not_null("seller_id", "null_seller_ids"),
        non_negative("seller_zip_code_prefix", "invalid_zip_prefixes"),
    ],
    "products": [
        unique(["product_id"], "duplicate_product_ids"),
        not_null("product_id", "null_product_ids"),
        non_negative("product_weight_g", "negative_weight"),
        non_negative("product_volume_cm3", "negative_volume"),
        non_negative("product_photos_qty", "invalid_photo_quantity"),
    ],
    "orders": [
        unique(["order_id"], "duplicate_order_ids"),
        not_null("order_id", "null_order_ids"),
        non_negative("delivery_duration_days", "negative_delivery_duration"),
        at_least("delivery_delay_days", -365, "suspicious_delivery_delay"),
    ],
    "order_items": [
        *[
            not_null(column, f"null_{column}")
            for column in (
                "order_id",
                "product_id",
                "seller_id",
                "order_item_id",
                "price",
                "freight_value",
                "shipping_limit_date",
            )
        ],
        unique(["order_id", "order_item_id"], "duplicate_order_item_records"),
        non_negative("price", "negative_prices"),
        non_negative("freight_value", "negative_freight"),
        rule("unusable_prices", ["price"], lambda: F.col("price").isNotNull() & amount("price").isNull()),
        rule("unusable_freight", ["freight_value"], lambda: F.col("freight_value").isNotNull() & amount("freight_value").isNull()),
        at_least("order_item_id", 1, "invalid_order_item_ids"),
        same_value(
            "total_item_value",
            lambda: F.col("price") + F.col("freight_value"),
            0.001,
            "incorrect_total_item_value",
            ["price", "freight_value"],
        ),
    ],
    "order_payments": [
        non_negative("payment_value", "negative_payment_values"),
        non_negative("payment_installments", "invalid_installments"),
        at_least("payment_sequential", 1, "invalid_sequential"),
        not_null("order_id", "null_order_ids"),
    ],
    "order_reviews": [
        between("review_score", 1, 5, "invalid_review_scores"),
        not_null("review_id", "null_review_ids"),
        not_null("order_id", "null_order_ids"),
    ],
    "geolocation": [
        between("geolocation_lat", -90, 90, "invalid_latitude"),
        between("geolocation_lng", -180, 180, "invalid_longitude"),
        not_null("geolocation_zip_code_prefix", "null_zip_prefix"),
    ],
    "product_category_name_translation": [
        unique(["product_category_name"], "duplicate_categories"),
        not_null("product_category_name", "null_categories"),
        not_null("product_category_name_english", "null_english_names"),
    ],
}

GOLD_SUITES: dict[str, list[Rule]] = {
    "fact_orders": [
        required_columns(
            [
                "order_id",
                "customer_id",
                "order_status",
                "order_purchase_timestamp",
                "delivery_duration_days",
                "delivery_delay_days",
                "is_late",
            ]
        ),
        not_null("order_id"),
        unique(["order_id"]),
        allowed("is_late", [0, 1]),
        non_negative("delivery_duration_days"),
    ],
    "fact_order_items": [
        required_columns(["order_id", "seller_id", "price", "freight_value"]),
        not_null("order_id"),
        not_null("seller_id"),
        non_negative("price"),
        non_negative("freight_value"),
    ],
    "seller_performance": [
        required_columns(
            [
                "order_id",
                "seller_id",
                "seller_order_count",
                "seller_late_order_count",
                "seller_late_rate",
                "seller_avg_delivery_delay_days",
            ]
        ),
        not_null("order_id"),
        not_null("seller_id"),
        unique(["order_id", "seller_id"]),
        non_negative("seller_order_count"),
        non_negative("seller_late_order_count"),
        between("seller_late_rate", 0.0, 1.0),
    ],
    "delivery_features": [
        required_columns(
            [
                "order_id",
                "customer_id",
                "order_item_count",
                "order_total_price",
                "order_total_freight",
                "purchase_hour",
                "purchase_day_of_week",
                "estimated_delivery_duration_days",
                "seller_count",
                "seller_avg_order_count",
                "seller_max_order_count",
                "seller_avg_late_rate",
                "seller_max_late_rate",
                "seller_avg_delivery_delay_days",
                "seller_max_delivery_delay_days",
                "is_late",
            ]
        ),
        not_null("order_id"),
        unique(["order_id"]),
        non_negative("order_item_count"),
        non_negative("order_total_price"),
        non_negative("order_total_freight"),
        non_negative("seller_count"),
        non_negative("seller_avg_order_count"),
        non_negative("seller_max_order_count"),
        between("seller_avg_late_rate", 0.0, 1.0),
        between("seller_max_late_rate", 0.0, 1.0),
        allowed("is_late", [0, 1]),
    ],
}


def check_silver(df: DataFrame, table: str) -> DataFrame:
    return run_checks(df, table, SILVER_SUITES[table])


def check_gold(df: DataFrame, table: str) -> DataFrame:
    return run_checks(df, table, GOLD_SUITES[table])
