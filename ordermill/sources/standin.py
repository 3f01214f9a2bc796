"""Raw order tables derived from TPC-H-like test tables (FIXTURES.md, section 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _days(count: Column | int) -> Column:
    return F.make_dt_interval(F.lit(count) if isinstance(count, int) else count.cast("int"))


def _customers(read) -> DataFrame:
    return (
        read("customer")
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )


def _sellers(read) -> DataFrame:
    return (
        read("supplier")
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )
    )


def _products(read) -> DataFrame:
    size = F.col("p_size")
    return read("part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(size % 10 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (size % 5).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size % 7 + 1).alias("product_height_cm"),
        (size % 11 + 1).alias("product_width_cm"),
    )


def _orders(read) -> DataFrame:
    lines = (
        read("lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_quantity").alias("q"), F.min("l_shipdate").alias("s"))
    )
    status = F.col("o_orderstatus")
    placed = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    return (
        read("orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(status == "F", "delivered")
            .when(status == "O", "shipped")
            .when(status == "P", "processing")
            .alias("order_status"),
            placed.alias("order_purchase_timestamp"),
            (placed + _days(1)).alias("order_approved_at"),
            F.col("s").alias("order_delivered_carrier_date"),
            F.when(status == "F", placed + _days(F.col("q"))).alias("order_delivered_customer_date"),
            (placed + _days(48)).alias("order_estimated_delivery_date"),
        )
    )


def _order_items(read) -> DataFrame:
    """Some orders have only items with a negative freight value."""
    # Whole cents times whole percent, rounded half up: exact decimal arithmetic in integers.
    freight = F.rint(F.col("l_extendedprice") * 100).cast("bigint") * F.rint(F.col("l_tax") * 100).cast("bigint")
    return read("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_orderkey") % 97 == 0, -1.0)
        .otherwise(F.floor((freight + 50) / 100) / F.lit(100.0))
        .alias("freight_value"),
    )


def _order_reviews(read) -> DataFrame:
    return read("events").select(
        F.col("event_id").alias("review_id"),
        F.col("event_id").alias("order_id"),
        (F.floor("value") % 5 + 1).alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        (F.col("ts") + _days(1)).alias("review_answer_timestamp"),
    )


def _order_payments(read) -> DataFrame:
    """One payment for each event; every tenth event's payment is in the table twice."""
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return read("events").select(
        F.col("event_id").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        (F.col("user_id") % 12 + 1).alias("payment_installments"),
        F.col("value").alias("payment_value"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _geolocation(read) -> DataFrame:
    """Customers as places: many repeat a zip code, position, city and state once these are cleaned."""
    return (
        read("customer")
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
            (F.col("c_custkey") % 7).cast("double").alias("geolocation_lat"),
            (F.col("c_custkey") % 5).cast("double").alias("geolocation_lng"),
            F.concat(F.lit("  "), F.upper("c_mktsegment")).alias("geolocation_city"),
            F.lower("n_name").alias("geolocation_state"),
        )
    )


def _category_translation(read) -> DataFrame:
    """Part types as categories, each with the names of several brands: one of them has to be kept."""
    return read("part").select(
        F.concat(F.upper("p_type"), F.lit(" ")).alias("product_category_name"),
        F.col("p_brand").alias("product_category_name_english"),
    )


_TABLES = {
    "customers": _customers,
    "sellers": _sellers,
    "products": _products,
    "orders": _orders,
    "order_items": _order_items,
    "order_reviews": _order_reviews,
    "order_payments": _order_payments,
    "geolocation": _geolocation,
    "product_category_name_translation": _category_translation,
}


def orders_as_text(orders: DataFrame) -> DataFrame:
    """The orders with times as a CSV scan without types gives them; some can't be read."""
    times = [f.name for f in orders.schema.fields if f.dataType.typeName().startswith("timestamp")]
    odd = F.col("order_id") % 89 == 0
    return orders.withColumns(
        {c: F.when(odd, "soon").otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss")) for c in times}
    )


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _TABLES[name](lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
