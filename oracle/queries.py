"""One SQL statement per registered query."""

from __future__ import annotations

from oracle import model
from oracle.tables import with_tables

_BODIES: dict[str, str] = {
    # --- cleaned tables ---
    "clean_customers": "SELECT * FROM customers",
    "clean_sellers": "SELECT * FROM sellers",
    "clean_products": "SELECT * FROM products",
    "clean_orders_from_text": """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
               datediff('day', order_purchase_timestamp, order_delivered_customer_date)::INTEGER
                   AS delivery_duration_days,
               datediff('day', order_estimated_delivery_date, order_delivered_customer_date)::INTEGER
                   AS delivery_delay_days,
               coalesce(datediff('day', order_estimated_delivery_date, order_delivered_customer_date) > 0, false)::INTEGER
                   AS is_late
        FROM (
            SELECT order_id, customer_id, order_status, TRY_CAST(bought AS TIMESTAMP) AS order_purchase_timestamp,
                   TRY_CAST(approved AS TIMESTAMP) AS order_approved_at,
                   TRY_CAST(sent AS TIMESTAMP) AS order_delivered_carrier_date,
                   TRY_CAST(arrived AS TIMESTAMP) AS order_delivered_customer_date,
                   TRY_CAST(promised AS TIMESTAMP) AS order_estimated_delivery_date
            FROM (
                SELECT order_id, customer_id, order_status,
                       CASE WHEN odd THEN 'soon' ELSE strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') END AS bought,
                       CASE WHEN odd THEN 'soon' ELSE strftime(order_approved_at, '%Y-%m-%d %H:%M:%S') END AS approved,
                       CASE WHEN odd THEN 'soon' ELSE strftime(order_delivered_carrier_date, '%Y-%m-%d %H:%M:%S') END AS sent,
                       CASE WHEN odd THEN 'soon' ELSE strftime(order_delivered_customer_date, '%Y-%m-%d %H:%M:%S') END AS arrived,
                       CASE WHEN odd THEN 'soon' ELSE strftime(order_estimated_delivery_date, '%Y-%m-%d %H:%M:%S') END AS promised
                FROM (SELECT *, order_id % 89 = 0 AS odd FROM raw_orders)))""",
    "clean_orders": "SELECT * FROM clean_orders",
    "clean_order_items": "SELECT * FROM items",
    "clean_payments": "SELECT * FROM payments",
    "clean_reviews": "SELECT * FROM reviews",
    "clean_geolocation": "SELECT * FROM places",
    "clean_category_translation": "SELECT * FROM translations",
    # --- star schema ---
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_products": "SELECT * FROM dim_products",
    "dim_sellers": "SELECT * FROM sellers",
    "fact_orders": "SELECT * FROM fact_orders",
    "fact_order_items": "SELECT * FROM fact_items",
    "fact_reviews": "SELECT * FROM fact_reviews",
    "seller_performance": "SELECT * FROM seller_perf",
    "delivery_features": "SELECT * FROM features",
    # --- customer KPIs ---
    "overall_customer_kpis": """
        SELECT count(DISTINCT customer_unique_id) AS total_customers, count(DISTINCT order_id) AS total_orders,
               round(count(DISTINCT order_id)::DOUBLE / count(DISTINCT customer_unique_id), 2) AS orders_per_customer,
               round(sum(order_total_price::DECIMAL(20, 6)) * 100 / count(DISTINCT customer_unique_id)) / 100
                   AS revenue_per_customer
        FROM features JOIN dim_customers USING (customer_id)""",
    "customer_performance_by_state": """
        SELECT customer_state, count(DISTINCT customer_unique_id) AS customers, count(DISTINCT order_id) AS orders,
               round(sum(order_total_price::DECIMAL(20, 6)), 2)::DOUBLE AS revenue,
               round(sum(order_total_price::DECIMAL(20, 6)) * 100 / count(order_total_price)) / 100
                   AS average_order_value
        FROM features JOIN dim_customers USING (customer_id)
        GROUP BY customer_state ORDER BY revenue DESC, customer_state""",
    "customers_by_number_of_orders": """
        SELECT CASE WHEN n = 1 THEN '1 order' WHEN n BETWEEN 2 AND 3 THEN '2-3 orders'
                    WHEN n BETWEEN 4 AND 5 THEN '4-5 orders' ELSE '6+ orders' END AS customer_segment,
               count(*) AS customers
        FROM (SELECT customer_unique_id, count(DISTINCT order_id) AS n
              FROM features JOIN dim_customers USING (customer_id) GROUP BY 1)
        GROUP BY 1 ORDER BY 1""",
    "monthly_customer_activity": """
        SELECT date_trunc('month', order_purchase_timestamp)::TIMESTAMP AS month,
               count(DISTINCT customer_unique_id) AS active_customers, count(DISTINCT f.order_id) AS orders,
               round(sum(order_total_price::DECIMAL(20, 6)), 2)::DOUBLE AS revenue
        FROM features f JOIN fact_orders o ON f.order_id = o.order_id
             JOIN dim_customers c ON f.customer_id = c.customer_id
        GROUP BY 1 ORDER BY 1""",
    # --- delivery KPIs ---
    "overall_delivery_kpis": """
        SELECT count(DISTINCT f.order_id) AS total_orders,
               round(avg(d.estimated_delivery_duration_days), 2) AS avg_estimated_delivery_days,
               round(avg(f.delivery_duration_days), 2) AS avg_actual_delivery_days,
               round(avg(CASE WHEN f.delivery_delay_days > 0 THEN f.delivery_delay_days ELSE 0 END), 2)
                   AS avg_delivery_delay_days,
               round(100 * sum(CASE WHEN f.is_late = 1 THEN 1 ELSE 0 END)::DOUBLE / count(DISTINCT f.order_id), 2)
                   AS late_delivery_rate
        FROM fact_orders f JOIN features d ON f.order_id = d.order_id""",
    "delivery_performance_by_month": """
        SELECT date_trunc('month', order_purchase_timestamp)::TIMESTAMP AS month, count(DISTINCT order_id) AS orders,
               round(avg(delivery_duration_days), 2) AS avg_delivery_days,
               round(avg(CASE WHEN delivery_delay_days > 0 THEN delivery_delay_days ELSE 0 END), 2) AS avg_delay_days,
               round(avg(is_late) * 100, 2) AS late_rate_percentage
        FROM fact_orders GROUP BY 1 ORDER BY 1""",
    "late_deliveries_by_seller": """
        SELECT seller_id, max(seller_order_count) AS orders, max(seller_late_order_count) AS late_orders,
               round(max(seller_late_rate) * 100, 2) AS late_rate_percentage,
               round(max(seller_avg_delivery_delay_days), 2) AS avg_delivery_delay_days
        FROM seller_perf GROUP BY seller_id HAVING max(seller_order_count) >= 20
        ORDER BY late_rate_percentage DESC, seller_id LIMIT 20""",
    "delivery_performance_by_order_status": """
        SELECT order_status, count(DISTINCT order_id) AS orders,
               round(avg(CASE WHEN order_status = 'delivered' THEN delivery_duration_days END), 2) AS avg_delivery_days,
               round(avg(CASE WHEN order_status = 'delivered' THEN greatest(delivery_delay_days, 0) END), 2)
                   AS avg_delay_days
        FROM fact_orders GROUP BY 1 ORDER BY orders DESC, order_status""",
    "late_delivery_by_purchase_day": """
        SELECT purchase_day_of_week, count(DISTINCT order_id) AS orders,
               round(avg(is_late) * 100, 2) AS late_rate_percentage
        FROM features GROUP BY 1 ORDER BY 1""",
    # --- product KPIs ---
    "overall_product_kpis": """
        SELECT count(DISTINCT product_id) AS total_products,
               round(sum(price::DECIMAL(20, 6)) * 100 / count(price)) / 100 AS average_product_price,
               round(sum(total_item_value::DECIMAL(20, 6)), 2)::DOUBLE AS total_product_revenue,
               round(sum(freight_value::DECIMAL(20, 6)), 2)::DOUBLE AS total_freight_revenue
        FROM fact_items""",
    "top_products_by_revenue": """
        SELECT product_id, count(DISTINCT order_id) AS orders,
               round(sum(total_item_value::DECIMAL(20, 6)), 2)::DOUBLE AS revenue,
               sum(price::DECIMAL(20, 6))::DOUBLE / count(price) AS average_price
        FROM fact_items GROUP BY 1 ORDER BY revenue DESC, product_id LIMIT 20""",
    "revenue_by_product_category": """
        SELECT coalesce(product_category_name, 'Unknown') AS category, count(DISTINCT order_id) AS orders,
               count(DISTINCT product_id) AS products, round(sum(total_item_value::DECIMAL(20, 6)), 2)::DOUBLE AS revenue,
               round(sum(price::DECIMAL(20, 6)) * 100 / count(price)) / 100 AS average_price
        FROM fact_items JOIN dim_products USING (product_id) GROUP BY 1 ORDER BY revenue DESC, category""",
    "freight_performance_by_category": """
        SELECT coalesce(product_category_name, 'Unknown') AS category,
               round(sum(freight_value::DECIMAL(20, 6)) * 100 / count(freight_value)) / 100 AS average_freight,
               round(sum(freight_value::DECIMAL(20, 6))::DOUBLE
                     / nullif(sum(total_item_value::DECIMAL(20, 6))::DOUBLE, 0) * 100, 2) AS freight_percentage
        FROM fact_items JOIN dim_products USING (product_id) GROUP BY 1 ORDER BY freight_percentage DESC, category""",
    # --- review KPIs ---
    "overall_review_kpis": """
        SELECT count(*) AS total_reviews, round(avg(review_score), 2) AS average_review_score FROM fact_reviews""",
    "review_score_distribution": """
        SELECT review_score, count(*) AS reviews,
               round(count(*) * 100::DOUBLE / sum(count(*)) OVER (), 2) AS percentage
        FROM fact_reviews GROUP BY 1 ORDER BY 1""",
    "review_score_vs_delivery_performance": """
        SELECT review_score, count(*) AS reviews,
               round(avg(CASE WHEN delivery_delay_days > 0 THEN delivery_delay_days ELSE 0 END), 2)
                   AS average_delivery_delay,
               round(avg(is_late) * 100, 2) AS late_delivery_rate
        FROM fact_reviews JOIN fact_orders USING (order_id) GROUP BY 1 ORDER BY 1""",
    "reviews_by_delivery_status": """
        SELECT CASE WHEN is_late = 1 THEN 'Late' ELSE 'On Time' END AS delivery_status, count(*) AS reviews,
               round(avg(review_score), 2) AS average_review_score
        FROM fact_reviews JOIN fact_orders USING (order_id) GROUP BY 1 ORDER BY 1""",
    "review_score_by_month": """
        SELECT date_trunc('month', review_creation_date)::TIMESTAMP AS month, count(*) AS reviews,
               round(avg(review_score), 2) AS average_review_score
        FROM fact_reviews GROUP BY 1 ORDER BY 1""",
    # --- sales KPIs ---
    "overall_sales_kpis": """
        SELECT count(DISTINCT order_id) AS total_orders, round(sum(order_total_price::DECIMAL(20, 6)), 2)::DOUBLE AS total_revenue,
               round(sum(order_total_price::DECIMAL(20, 6)) * 100 / count(order_total_price)) / 100
                   AS average_order_value,
               round(min(order_total_price), 2) AS minimum_order_value,
               round(max(order_total_price), 2) AS maximum_order_value
        FROM features""",
    "monthly_sales_performance": """
        SELECT date_trunc('month', order_purchase_timestamp)::TIMESTAMP AS month, count(DISTINCT f.order_id) AS orders,
               round(sum(order_total_price::DECIMAL(20, 6)), 2)::DOUBLE AS revenue,
               round(sum(order_total_price::DECIMAL(20, 6)) * 100 / count(order_total_price)) / 100
                   AS average_order_value
        FROM features f JOIN fact_orders o ON f.order_id = o.order_id GROUP BY 1 ORDER BY 1""",
    "sales_by_order_status": """
        SELECT order_status, count(DISTINCT order_id) AS total_orders,
               round(sum(order_total_price::DECIMAL(20, 6)), 2)::DOUBLE AS total_revenue,
               round(sum(order_total_price::DECIMAL(20, 6)) * 100 / count(order_total_price)) / 100
                   AS average_order_value
        FROM features GROUP BY 1 ORDER BY total_revenue DESC, order_status""",
    "late_orders_impact_on_sales": """
        SELECT is_late, count(DISTINCT order_id) AS total_orders,
               round(sum(order_total_price::DECIMAL(20, 6)), 2)::DOUBLE AS total_revenue,
               round(sum(order_total_price::DECIMAL(20, 6)) * 100 / count(order_total_price)) / 100
                   AS average_order_value
        FROM features GROUP BY 1 ORDER BY 1""",
    # --- seller KPIs ---
    "overall_seller_kpis": """
        SELECT count(DISTINCT seller_id) AS total_sellers, count(DISTINCT order_id) AS total_orders FROM seller_perf""",
    "top_sellers_by_orders": """
        SELECT seller_id, max(seller_order_count) AS total_orders, max(seller_late_order_count) AS late_orders,
               round(max(seller_late_rate) * 100, 2) AS late_rate_percentage,
               round(sum(round(seller_avg_delivery_delay_days * 100)) / count(seller_avg_delivery_delay_days)) / 100
                   AS average_delivery_delay_days
        FROM seller_perf GROUP BY 1 ORDER BY total_orders DESC, seller_id LIMIT 20""",
    "worst_sellers_by_late_rate": """
        SELECT seller_id, max(seller_order_count) AS total_orders, max(seller_late_order_count) AS late_orders,
               round(max(seller_late_rate) * 100, 2) AS late_rate_percentage,
               round(sum(round(seller_avg_delivery_delay_days * 100)) / count(seller_avg_delivery_delay_days)) / 100
                   AS average_delivery_delay_days
        FROM seller_perf GROUP BY 1 HAVING max(seller_order_count) >= 20
        ORDER BY late_rate_percentage DESC, seller_id LIMIT 20""",
    "seller_performance_distribution": """
        SELECT CASE WHEN rate < 0.10 THEN 'Excellent (<10%)' WHEN rate < 0.20 THEN 'Good (10-20%)'
                    WHEN rate < 0.30 THEN 'Average (20-30%)' ELSE 'Poor (30%+)' END AS seller_performance,
               count(*) AS sellers
        FROM (SELECT seller_id, max(seller_late_rate) AS rate FROM seller_perf GROUP BY 1) GROUP BY 1 ORDER BY 1""",
    # --- profiling ---
    "order_status_distribution": """
        SELECT order_status, count(*) AS rows, round(count(*) * 100::DOUBLE / sum(count(*)) OVER (), 6) AS percentage
        FROM raw_orders GROUP BY 1 ORDER BY rows DESC, order_status""",
    "late_flag_distribution": """
        SELECT coalesce(order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_late,
               count(*) AS rows, round(count(*) * 100::DOUBLE / sum(count(*)) OVER (), 6) AS percentage
        FROM raw_orders GROUP BY 1 ORDER BY rows DESC, is_late""",
    "seller_history_preview": """
        SELECT * FROM seller_perf ORDER BY seller_id, order_purchase_timestamp, order_id LIMIT 20""",
    "order_status_counts": "SELECT order_status, count(*) AS rows FROM clean_orders GROUP BY 1",
    "order_late_counts": "SELECT is_late, count(*) AS rows FROM clean_orders GROUP BY 1",
    "payment_type_counts": "SELECT payment_type, count(*) AS rows FROM payments GROUP BY 1",
    "review_score_counts": "SELECT review_score, count(*) AS rows FROM reviews GROUP BY 1",
    "item_value_summary": """
        SELECT 'price' AS column, min(price) AS min_value, max(price) AS max_value,
               round(sum(price::DECIMAL(20, 6))::DOUBLE / count(price), 4) AS avg_value FROM items
        UNION ALL
        SELECT 'freight_value', min(freight_value), max(freight_value),
               round(sum(freight_value::DECIMAL(20, 6))::DOUBLE / count(freight_value), 4) FROM items""",
    "delay_days": """
        SELECT order_id, (epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date))
                         / 86400000000 AS delivery_delay_days,
               coalesce(order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_late
        FROM raw_orders""",
    "seller_ranking_full_history": """
        SELECT seller_id, count(DISTINCT order_id) AS orders, round(avg(is_late::INTEGER), 6) AS late_rate,
               round(avg(delay), 6) AS avg_delay_days
        FROM (SELECT DISTINCT order_id, seller_id FROM raw_items) LEFT JOIN (
            SELECT order_id,
                   (epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date)) / 86400000000
                       AS delay,
                   coalesce(order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_late
            FROM raw_orders) USING (order_id)
        WHERE seller_id IS NOT NULL GROUP BY 1 ORDER BY late_rate DESC, seller_id LIMIT 20""",
    # --- quality, beyond the suites below ---
    "referential_integrity": """
        SELECT 'orders_customer_id' AS check,
               (SELECT count(DISTINCT customer_id) FROM raw_orders
                WHERE customer_id NOT IN (SELECT customer_id FROM raw_customers)) AS violations,
               (SELECT count(*) FROM raw_orders WHERE customer_id IS NULL) AS null_keys
        UNION ALL
        SELECT 'order_items_product_id',
               (SELECT count(DISTINCT product_id) FROM raw_items
                WHERE product_id NOT IN (SELECT product_id FROM raw_products)),
               (SELECT count(*) FROM raw_items WHERE product_id IS NULL)
        UNION ALL
        SELECT 'order_items_seller_id',
               (SELECT count(DISTINCT seller_id) FROM raw_items
                WHERE seller_id NOT IN (SELECT seller_id FROM raw_sellers)),
               (SELECT count(*) FROM raw_items WHERE seller_id IS NULL)""",
    # --- model inputs ---
    "training_set": "SELECT * FROM training WHERE is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL",
    "training_summary": """
        SELECT count(*) FILTER (is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL) AS rows,
               count(*) FILTER (is_late IS NULL) AS removed_missing_target,
               count(*) FILTER (is_late IS NOT NULL AND order_purchase_timestamp IS NULL) AS removed_missing_timestamp,
               count(*) FILTER (is_late = 1 AND order_purchase_timestamp IS NOT NULL) AS late_orders,
               count(*) FILTER (is_late = 0 AND order_purchase_timestamp IS NOT NULL) AS on_time_orders,
               count(*) FILTER (is_late = 1 AND order_purchase_timestamp IS NOT NULL)::DOUBLE
                   / count(*) FILTER (is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL) AS late_rate,
               min(order_purchase_timestamp) FILTER (is_late IS NOT NULL) AS start_date,
               max(order_purchase_timestamp) FILTER (is_late IS NOT NULL) AS end_date
        FROM training""",
}

_TRAINING_COLUMNS = [
    "order_item_count",
    "order_total_price",
    "order_total_freight",
    "purchase_hour",
    "purchase_day_of_week",
    "estimated_delivery_duration_days",
]
_BODIES["imputed_features"] = (
    "SELECT order_id, "
    + ", ".join(
        f"coalesce({c}::DOUBLE, (SELECT median({c}::DOUBLE) FROM labelled)) AS {c}" for c in _TRAINING_COLUMNS
    )
    + ", is_late FROM (SELECT * FROM training WHERE is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL)"
).replace("FROM labelled", "FROM training WHERE is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL")


# --- quality suites: (check, violations expression), plus one keyed count each ---


def _suite(dataset: str, source: str, checks: list[tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS \"check\", ({sql})::BIGINT AS violations" for name, sql in checks
    ).replace("{t}", source)
    return f"SELECT dataset, \"check\", violations, violations = 0 AS passed FROM ({rows})"


def _where(condition: str) -> str:
    return f"SELECT count(*) FROM {{t}} WHERE {condition}"


def _repeats(keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {{t}} GROUP BY {keys} HAVING count(*) > 1)"


_SUITES = {
    "quality_customers": (
        "customers",
        "customers",
        [
            ("duplicate_customer_ids", _repeats("customer_id")),
            ("null_customer_ids", _where("customer_id IS NULL")),
            ("invalid_zip_prefixes", _where("customer_zip_code_prefix < 0")),
        ],
    ),
    "quality_sellers": (
        "sellers",
        "sellers",
        [
            ("duplicate_seller_ids", _repeats("seller_id")),
            ("null_seller_ids", _where("seller_id IS NULL")),
            ("invalid_zip_prefixes", _where("seller_zip_code_prefix < 0")),
        ],
    ),
    "quality_products": (
        "products",
        "products",
        [
            ("duplicate_product_ids", _repeats("product_id")),
            ("null_product_ids", _where("product_id IS NULL")),
            ("negative_weight", _where("product_weight_g < 0")),
            ("negative_volume", _where("product_volume_cm3 < 0")),
            ("invalid_photo_quantity", _where("product_photos_qty < 0")),
        ],
    ),
    "quality_orders": (
        "orders",
        "clean_orders",
        [
            ("duplicate_order_ids", _repeats("order_id")),
            ("null_order_ids", _where("order_id IS NULL")),
            ("negative_delivery_duration", _where("delivery_duration_days < 0")),
            ("suspicious_delivery_delay", _where("delivery_delay_days < -365")),
        ],
    ),
    "quality_order_items": (
        "order_items",
        "items",
        [
            *[
                (f"null_{c}", _where(f"{c} IS NULL"))
                for c in (
                    "order_id",
                    "product_id",
                    "seller_id",
                    "order_item_id",
                    "price",
                    "freight_value",
                    "shipping_limit_date",
                )
            ],
            ("duplicate_order_item_records", _repeats("order_id, order_item_id")),
            ("negative_prices", _where("price < 0")),
            ("negative_freight", _where("freight_value < 0")),
            ("unusable_prices", _where("price IS NOT NULL AND try_cast(price AS DECIMAL(20, 6)) IS NULL")),
            ("unusable_freight", _where("freight_value IS NOT NULL AND try_cast(freight_value AS DECIMAL(20, 6)) IS NULL")),
            ("invalid_order_item_ids", _where("order_item_id < 1")),
            ("incorrect_total_item_value", _where("abs(total_item_value - (price + freight_value)) >= 0.001")),
        ],
    ),
    "quality_payments": (
        "order_payments",
        "payments",
        [
            ("negative_payment_values", _where("payment_value < 0")),
            ("invalid_installments", _where("payment_installments < 0")),
            ("invalid_sequential", _where("payment_sequential < 1")),
            ("null_order_ids", _where("order_id IS NULL")),
        ],
    ),
    "quality_reviews": (
        "order_reviews",
        "reviews",
        [
            ("invalid_review_scores", _where("review_score < 1 OR review_score > 5")),
            ("null_review_ids", _where("review_id IS NULL")),
            ("null_order_ids", _where("order_id IS NULL")),
        ],
    ),
    "quality_geolocation": (
        "geolocation",
        "places",
        [
            ("invalid_latitude", _where("geolocation_lat < -90 OR geolocation_lat > 90")),
            ("invalid_longitude", _where("geolocation_lng < -180 OR geolocation_lng > 180")),
            ("null_zip_prefix", _where("geolocation_zip_code_prefix IS NULL")),
        ],
    ),
    "quality_category_translation": (
        "product_category_name_translation",
        "translations",
        [
            ("duplicate_categories", _repeats("product_category_name")),
            ("null_categories", _where("product_category_name IS NULL")),
            ("null_english_names", _where("product_category_name_english IS NULL")),
        ],
    ),
    "quality_gold_fact_orders": (
        "fact_orders",
        "fact_orders",
        [
            ("required_columns", "0"),
            ("order_id_not_null", _where("order_id IS NULL")),
            ("order_id_unique", _repeats("order_id")),
            ("is_late_allowed", _where("is_late NOT IN (0, 1)")),
            ("delivery_duration_days_non_negative", _where("delivery_duration_days < 0")),
        ],
    ),
    "quality_gold_fact_order_items": (
        "fact_order_items",
        "fact_items",
        [
            ("required_columns", "0"),
            ("order_id_not_null", _where("order_id IS NULL")),
            ("seller_id_not_null", _where("seller_id IS NULL")),
            ("price_non_negative", _where("price < 0")),
            ("freight_value_non_negative", _where("freight_value < 0")),
        ],
    ),
    "quality_gold_seller_performance": (
        "seller_performance",
        "seller_perf",
        [
            ("required_columns", "0"),
            ("order_id_not_null", _where("order_id IS NULL")),
            ("seller_id_not_null", _where("seller_id IS NULL")),
            ("order_id_seller_id_unique", _repeats("order_id, seller_id")),
            ("seller_order_count_non_negative", _where("seller_order_count < 0")),
            ("seller_late_order_count_non_negative", _where("seller_late_order_count < 0")),
            ("seller_late_rate_between", _where("seller_late_rate < 0 OR seller_late_rate > 1")),
        ],
    ),
    "quality_gold_delivery_features": (
        "delivery_features",
        "features",
        [
            ("required_columns", "0"),
            ("order_id_not_null", _where("order_id IS NULL")),
            ("order_id_unique", _repeats("order_id")),
            *[
                (f"{c}_non_negative", _where(f"{c} < 0"))
                for c in (
                    "order_item_count",
                    "order_total_price",
                    "order_total_freight",
                    "seller_count",
                    "seller_avg_order_count",
                    "seller_max_order_count",
                )
            ],
            *[
                (f"{c}_between", _where(f"{c} < 0 OR {c} > 1"))
                for c in ("seller_avg_late_rate", "seller_max_late_rate")
            ],
            ("is_late_allowed", _where("is_late NOT IN (0, 1)")),
        ],
    ),
    "chronology_rules": (
        "orders",
        "raw_orders",
        [
            ("delivered_before_purchase", _where("order_delivered_customer_date < order_purchase_timestamp")),
            ("missing_delivered_date", _where("order_delivered_customer_date IS NULL")),
            ("missing_estimated_date", _where("order_estimated_delivery_date IS NULL")),
        ],
    ),
    "feature_grain": (
        "delivery_features",
        "features",
        [("one_row_per_order", "SELECT count(*) - count(DISTINCT order_id) FROM {t}")],
    ),
}
_BODIES |= {key: _suite(*spec) for key, spec in _SUITES.items()}


# --- profiles over several raw tables ---

_RAW = {
    "customers": ("raw_customers", {
        "customer_id": "bigint", "customer_unique_id": "bigint", "customer_zip_code_prefix": "int",
        "customer_city": "string", "customer_state": "string"}),
    "geolocation": ("raw_places", {
        "geolocation_zip_code_prefix": "int", "geolocation_lat": "double", "geolocation_lng": "double",
        "geolocation_city": "string", "geolocation_state": "string"}),
    "order_items": ("raw_items", {
        "order_id": "bigint", "order_item_id": "int", "product_id": "bigint", "seller_id": "bigint",
        "shipping_limit_date": "timestamp_ntz", "price": "double", "freight_value": "double"}),
    "order_payments": ("raw_payments", {
        "order_id": "bigint", "payment_sequential": "int", "payment_type": "string",
        "payment_installments": "bigint", "payment_value": "double"}),
    "order_reviews": ("raw_reviews", {
        "review_id": "bigint", "order_id": "bigint", "review_score": "bigint", "review_comment_title": "string",
        "review_comment_message": "string", "review_creation_date": "timestamp_ntz",
        "review_answer_timestamp": "timestamp_ntz"}),
    "orders": ("raw_orders", {
        "order_id": "bigint", "customer_id": "bigint", "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz", "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz", "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz"}),
    "product_category_name_translation": ("raw_translations", {
        "product_category_name": "string", "product_category_name_english": "string"}),
    "products": ("raw_products", {
        "product_id": "bigint", "product_category_name": "string", "product_name_lenght": "int",
        "product_description_lenght": "int", "product_photos_qty": "int", "product_weight_g": "int",
        "product_length_cm": "int", "product_height_cm": "int", "product_width_cm": "int"}),
    "sellers": ("raw_sellers", {
        "seller_id": "bigint", "seller_zip_code_prefix": "int", "seller_city": "string", "seller_state": "string"}),
}

_BODIES["profile_overview"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS rows, {len(columns)} AS columns FROM {source}"
    for name, (source, columns) in _RAW.items()
)
_METADATA = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{c}' AS \"column\", '{dtype}' AS dtype, count(*) - count({c}) AS missing_count, "
    f"round((count(*) - count({c})) * 100::DOUBLE / count(*), 6) AS missing_pct, "
    f"count(DISTINCT {c}) AS unique_count FROM {source}"
    for name, (source, columns) in _RAW.items()
    for c, dtype in columns.items()
)
_BODIES["profile_columns"] = _METADATA
_BODIES["profile_missing"] = f"SELECT * FROM ({_METADATA}) WHERE missing_count > 0"
_BODIES["profile_duplicates"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, (SELECT count(*) FROM {source}) AS rows, "
    f"(SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS duplicate_rows, "
    f"((SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))) * 100::DOUBLE "
    f"/ (SELECT count(*) FROM {source}) AS duplicate_pct"
    for name, (source, _) in _RAW.items()
)
_KEYS = {
    "customers": ["customer_id"],
    "order_items": ["order_id", "product_id", "seller_id"],
    "orders": ["order_id", "customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
}
_BODIES["key_cardinality"] = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{k}' AS \"column\", count(*) AS rows, count(DISTINCT {k}) AS distinct_values "
    f"FROM {_RAW[name][0]}"
    for name, keys in _KEYS.items()
    for k in keys
)


def _described(column: str, value: str, places: int = 6) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count(v) AS count, round(avg(v), {places}) AS mean, "
        f"round(stddev_samp(v), {places}) AS std, min(v) AS min, quantile_cont(v, 0.25) AS p25, "
        f"quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, max(v) AS max "
        f"FROM (SELECT {value} AS v FROM raw_orders)"
    )


_BODIES["delay_describe"] = _described(
    "delivery_delay_days",
    "(epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date)) / 86400000000",
)
_BODIES["timeline_describe"] = " UNION ALL ".join(
    _described(c, f"epoch_us({c}) / 1000000", 2)
    for c in (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
)

ORACLE: dict[str, str] = {name: with_tables(body) for name, body in _BODIES.items()} | model.ORACLE
