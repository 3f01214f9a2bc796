"""Common table expressions: raw, cleaned and star-schema tables over the test tables."""

from __future__ import annotations

import re

CTES: dict[str, str] = {
    # --- raw tables, FIXTURES.md section 2 ---
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, s_name AS seller_city,
               n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_type END AS product_category_name,
               length(p_name)::INTEGER AS product_name_lenght, length(p_brand)::INTEGER AS product_description_lenght,
               p_size % 5 AS product_photos_qty, p_size * 100 AS product_weight_g, p_size AS product_length_cm,
               p_size % 7 + 1 AS product_height_cm, p_size % 11 + 1 AS product_width_cm
        FROM part""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'processing' END
                   AS order_status,
               placed AS order_purchase_timestamp,
               placed + INTERVAL 1 DAY AS order_approved_at,
               s AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus = 'F' THEN placed + to_days(q::INTEGER) END
                   AS order_delivered_customer_date,
               placed + INTERVAL 48 DAY AS order_estimated_delivery_date
        FROM (SELECT *, o_orderdate + to_hours(o_orderkey % 24) AS placed FROM orders) LEFT JOIN (
            SELECT l_orderkey, max(l_quantity) AS q, min(l_shipdate) AS s FROM lineitem GROUP BY l_orderkey
        ) ON o_orderkey = l_orderkey""",
    "raw_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
               CASE WHEN l_orderkey % 97 = 0 THEN -1
                    ELSE round(l_extendedprice::DECIMAL(18, 2) * l_tax::DECIMAL(18, 2), 2)::DOUBLE END AS freight_value
        FROM lineitem""",
    "raw_reviews": """
        SELECT event_id AS review_id, event_id AS order_id, (floor(value)::BIGINT % 5 + 1) AS review_score,
               event_type AS review_comment_title, props AS review_comment_message, ts AS review_creation_date,
               ts + INTERVAL 1 DAY AS review_answer_timestamp
        FROM events""",
    "raw_payments": """
        SELECT event_id AS order_id, 1 AS payment_sequential, event_type AS payment_type,
               user_id % 12 + 1 AS payment_installments, value AS payment_value
        FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0)""",
    "raw_places": """
        SELECT c_nationkey AS geolocation_zip_code_prefix, (c_custkey % 7)::DOUBLE AS geolocation_lat,
               (c_custkey % 5)::DOUBLE AS geolocation_lng, '  ' || upper(c_mktsegment) AS geolocation_city,
               lower(n_name) AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_translations": """
        SELECT upper(p_type) || ' ' AS product_category_name, p_brand AS product_category_name_english FROM part""",
    # --- cleaned tables ---
    "customers": """
        SELECT customer_id, customer_unique_id, customer_zip_code_prefix::INTEGER AS customer_zip_code_prefix,
               trim(lower(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state
        FROM raw_customers
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id, customer_zip_code_prefix) = 1""",
    "sellers": """
        SELECT seller_id, seller_zip_code_prefix::INTEGER AS seller_zip_code_prefix,
               trim(lower(seller_city)) AS seller_city, upper(trim(seller_state)) AS seller_state
        FROM raw_sellers
        QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix) = 1""",
    "products": """
        SELECT product_id, trim(lower(product_category_name)) AS product_category_name,
               product_name_lenght::DOUBLE AS product_name_lenght,
               product_description_lenght::DOUBLE AS product_description_lenght,
               product_photos_qty::DOUBLE AS product_photos_qty, product_weight_g::DOUBLE AS product_weight_g,
               product_length_cm::DOUBLE AS product_length_cm, product_height_cm::DOUBLE AS product_height_cm,
               product_width_cm::DOUBLE AS product_width_cm,
               product_length_cm::DOUBLE * product_height_cm * product_width_cm AS product_volume_cm3
        FROM raw_products
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY product_category_name) = 1""",
    "clean_orders": """
        SELECT *,
               datediff('day', order_purchase_timestamp, order_delivered_customer_date)::INTEGER
                   AS delivery_duration_days,
               datediff('day', order_estimated_delivery_date, order_delivered_customer_date)::INTEGER
                   AS delivery_delay_days,
               CASE WHEN datediff('day', order_estimated_delivery_date, order_delivered_customer_date) > 0
                    THEN 1 ELSE 0 END::INTEGER AS is_late
        FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id, order_status) = 1""",
    "items": """
        SELECT DISTINCT *, price + freight_value AS total_item_value FROM raw_items
        WHERE price >= 0 AND freight_value >= 0""",
    "reviews": """
        SELECT review_id, order_id, review_score::INTEGER AS review_score,
               trim(review_comment_title) AS review_comment_title,
               trim(review_comment_message) AS review_comment_message, review_creation_date, review_answer_timestamp
        FROM raw_reviews
        QUALIFY row_number() OVER (PARTITION BY review_id, order_id ORDER BY review_score) = 1""",
    "payments": """
        SELECT DISTINCT order_id, payment_sequential, trim(lower(payment_type)) AS payment_type,
               payment_installments::INTEGER AS payment_installments, payment_value
        FROM raw_payments""",
    "places": """
        SELECT DISTINCT c_nationkey::INTEGER AS geolocation_zip_code_prefix, (c_custkey % 7)::DOUBLE AS geolocation_lat,
               (c_custkey % 5)::DOUBLE AS geolocation_lng, lower(c_mktsegment) AS geolocation_city,
               upper(n_name) AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "translations": """
        SELECT lower(p_type) AS product_category_name, min(lower(p_brand)) AS product_category_name_english
        FROM part GROUP BY 1""",
    # --- star schema ---
    "dim_customers": "SELECT * FROM customers",
    "dim_products": "SELECT * EXCLUDE (product_volume_cm3) FROM products",
    "fact_orders": """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
               delivery_duration_days, delivery_delay_days,
               CASE WHEN delivery_delay_days IS NULL THEN NULL WHEN delivery_delay_days > 0 THEN 1 ELSE 0 END::INTEGER
                   AS is_late
        FROM clean_orders""",
    "fact_items": """
        SELECT i.order_id, order_item_id, product_id, seller_id, customer_id, order_status, shipping_limit_date,
               price, freight_value, total_item_value, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
        FROM items i LEFT JOIN clean_orders o ON i.order_id = o.order_id""",
    "fact_reviews": "SELECT * FROM reviews",
    "history": """
        SELECT order_id, seller_id, order_purchase_timestamp,
               count(*) OVER w AS prior, sum(is_late) OVER w AS prior_late,
               sum(delivery_delay_days) OVER w AS prior_delay, count(delivery_delay_days) OVER w AS prior_delays
        FROM (SELECT DISTINCT order_id, seller_id FROM fact_items) JOIN fact_orders USING (order_id)
        WINDOW w AS (PARTITION BY seller_id ORDER BY order_purchase_timestamp, order_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "seller_perf": """
        SELECT order_id, seller_id, order_purchase_timestamp, prior AS seller_order_count,
               prior_late::BIGINT AS seller_late_order_count,
               -- Scaled before dividing, so that halves are exact when they are rounded.
               round(CASE WHEN prior > 0 THEN prior_late * 10000::DOUBLE / prior END) / 10000 AS seller_late_rate,
               round(CASE WHEN prior_delays > 0 THEN prior_delay * 100::DOUBLE / prior_delays END) / 100
                   AS seller_avg_delivery_delay_days
        FROM history""",
    "item_totals": """
        SELECT order_id, count(*) AS order_item_count,
               round(sum(price::DECIMAL(20, 6)), 2)::DOUBLE AS order_total_price,
               round(sum(freight_value::DECIMAL(20, 6)), 2)::DOUBLE AS order_total_freight
        FROM fact_items GROUP BY order_id""",
    "seller_totals": """
        SELECT order_id, count(seller_id) AS seller_count, 
               round(sum(seller_order_count) * 100::DOUBLE / count(seller_order_count)) / 100 AS seller_avg_order_count,
               max(seller_order_count) AS seller_max_order_count,
               round(sum(round(seller_late_rate * 10000)) / count(seller_late_rate)) / 10000 AS seller_avg_late_rate,
               max(seller_late_rate) AS seller_max_late_rate,
               round(sum(round(seller_avg_delivery_delay_days * 100)) / count(seller_avg_delivery_delay_days)) / 100
                   AS seller_avg_delivery_delay_days,
               max(seller_avg_delivery_delay_days) AS seller_max_delivery_delay_days
        FROM (SELECT DISTINCT order_id, seller_id FROM fact_items) JOIN seller_perf USING (order_id, seller_id)
        GROUP BY order_id""",
    "features": """
        SELECT f.order_id, customer_id, order_status, order_item_count, order_total_price, order_total_freight,
               hour(order_purchase_timestamp)::INTEGER AS purchase_hour,
               (dayofweek(order_purchase_timestamp) + 1)::INTEGER AS purchase_day_of_week,
               datediff('day', order_purchase_timestamp, order_estimated_delivery_date)::INTEGER
                   AS estimated_delivery_duration_days,
               seller_count, seller_avg_order_count, seller_max_order_count, seller_avg_late_rate,
               seller_max_late_rate, seller_avg_delivery_delay_days, seller_max_delivery_delay_days, is_late
        FROM fact_orders f LEFT JOIN item_totals i ON f.order_id = i.order_id
             LEFT JOIN seller_totals s ON f.order_id = s.order_id""",
    "training": """
        SELECT order_id, order_item_count, order_total_price, order_total_freight, purchase_hour,
               purchase_day_of_week, estimated_delivery_duration_days, is_late, order_purchase_timestamp
        FROM features LEFT JOIN (SELECT order_id, order_purchase_timestamp FROM fact_orders) USING (order_id)""",
}

_NAMES = list(CTES)


def _mentions(sql: str) -> set[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return {name for name in _NAMES if name in words}


def with_tables(body: str) -> str:
    """``body`` behind the expressions it needs, directly or through others."""
    needed, queue = set(), _mentions(body)
    while queue:
        name = queue.pop()
        needed.add(name)
        queue |= _mentions(CTES[name]) - needed
    parts = [f"{name} AS ({CTES[name].strip()})" for name in _NAMES if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip() if parts else body.strip()
