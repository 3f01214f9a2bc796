"""Cleaning operators: raw table in, typed, normalised and deduplicated table out.

Each is one projection and at most one shuffle. Extra input columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import days_between, late_or_not, lower_text, moment, real, upper_text, whole
from ordermill.operators.dedup import keep_one

ORDER_TIMES = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

# "lenght" is how the source data spells these two columns.
PRODUCT_MEASURES = [
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]

GEOLOCATION_KEY = [
    "geolocation_zip_code_prefix",
    "geolocation_lat",
    "geolocation_lng",
    "geolocation_city",
    "geolocation_state",
]


def _clean_place(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumns(
        {
            f"{prefix}_zip_code_prefix": whole(f"{prefix}_zip_code_prefix"),
            f"{prefix}_city": lower_text(f"{prefix}_city"),
            f"{prefix}_state": upper_text(f"{prefix}_state"),
        }
    )


def clean_customers(df: DataFrame) -> DataFrame:
    return keep_one(_clean_place(df, "customer"), ["customer_id"])


def clean_sellers(df: DataFrame) -> DataFrame:
    return keep_one(_clean_place(df, "seller"), ["seller_id"])


def clean_products(df: DataFrame) -> DataFrame:
    typed = df.withColumns(
        {name: real(name) for name in PRODUCT_MEASURES}
        | {"product_category_name": lower_text("product_category_name")}
    )
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return keep_one(typed, ["product_id"]).withColumn("product_volume_cm3", volume)


def clean_orders(df: DataFrame) -> DataFrame:
    """Adds duration and delay in days and a two-valued late flag (unknown outcomes are 0 here)."""
    timed = df.withColumns({name: moment(df, name) for name in ORDER_TIMES})
    return (
        keep_one(timed, ["order_id"])
        .withColumns(
            {
                "delivery_duration_days": days_between("order_delivered_customer_date", "order_purchase_timestamp"),
                "delivery_delay_days": days_between("order_delivered_customer_date", "order_estimated_delivery_date"),
            }
        )
        .withColumn("is_late", late_or_not("delivery_delay_days"))
    )


def clean_order_items(df: DataFrame) -> DataFrame:
    """Exact duplicates removed; rows whose price or freight is negative or unknown are dropped.

    The row filter runs before the deduplication: same result, less to shuffle.
    """
    typed = df.withColumns(
        {
            "shipping_limit_date": moment(df, "shipping_limit_date"),
            "price": real("price"),
            "freight_value": real("freight_value"),
            "order_item_id": whole("order_item_id"),
        }
    )
    return (
        typed.filter((F.col("price") >= 0) & (F.col("freight_value") >= 0))
        .dropDuplicates()
        .withColumn("total_item_value", F.col("price") + F.col("freight_value"))
    )


def clean_payments(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "payment_sequential": whole("payment_sequential"),
            "payment_installments": whole("payment_installments"),
            "payment_value": real("payment_value"),
            "payment_type": lower_text("payment_type"),
        }
    ).dropDuplicates()


def clean_reviews(df: DataFrame) -> DataFrame:
    typed = df.withColumns(
        {
            "review_score": whole("review_score"),
            "review_creation_date": moment(df, "review_creation_date"),
            "review_answer_timestamp": moment(df, "review_answer_timestamp"),
            "review_comment_title": F.trim("review_comment_title"),
            "review_comment_message": F.trim("review_comment_message"),
        }
    )
    return keep_one(typed, ["review_id", "order_id"])


def clean_geolocation(df: DataFrame) -> DataFrame:
    placed = _clean_place(df, "geolocation").withColumns(
        {"geolocation_lat": real("geolocation_lat"), "geolocation_lng": real("geolocation_lng")}
    )
    return keep_one(placed, GEOLOCATION_KEY)


def clean_category_translation(df: DataFrame) -> DataFrame:
    normal = df.withColumns(
        {
            "product_category_name": lower_text("product_category_name"),
            "product_category_name_english": lower_text("product_category_name_english"),
        }
    )
    return keep_one(normal, ["product_category_name"])
