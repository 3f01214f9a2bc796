"""The raw tables: one declared schema each, so a scan never has to infer types first."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dataset:
    """``schema`` is DDL text. ``multi_line``: quoted fields may hold line breaks; Spark cannot split
    such a file, so keep those tables in many files."""

    name: str
    schema: str
    multi_line: bool = False


# Table names, column names and types of the raw data.
DATASETS = {
    d.name: d
    for d in [
        Dataset(
            "customers",
            (
                "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
                "customer_city string, customer_state string"
            ),
        ),
        Dataset(
            "sellers",
            "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
        ),
        Dataset(
            "products",
            (
                "product_id string, product_category_name string, product_name_lenght double, "
                "product_description_lenght double, product_photos_qty double, product_weight_g double, "
                "product_length_cm double, product_height_cm double, product_width_cm double"
            ),
        ),
        Dataset(
            "orders",
            (
                "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
                "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
                "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
            ),
        ),
        Dataset(
            "order_items",
            (
                "order_id string, order_item_id int, product_id string, seller_id string, "
                "shipping_limit_date timestamp, price double, freight_value double"
            ),
        ),
        Dataset(
            "order_payments",
            (
                "order_id string, payment_sequential int, payment_type string, payment_installments int, "
                "payment_value double"
            ),
        ),
        Dataset(
            "order_reviews",
            (
                "review_id string, order_id string, review_score int, review_comment_title string, "
                "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
            ),
            multi_line=True,
        ),
        Dataset(
            "geolocation",
            (
                "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
                "geolocation_city string, geolocation_state string"
            ),
        ),
        Dataset(
            "product_category_name_translation",
            "product_category_name string, product_category_name_english string",
        ),
    ]
}
