"""One key with a third of all rows: adaptive execution must be able to split every fact join."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ordermill.operators.star import fact_order_items
from ordermill.plans.kpis import customers, products, reviews

# Thresholds scaled down to test size, so that a few thousand rows count as a big partition.
SMALL_SCALE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}
ROWS = 30_000


@pytest.fixture(autouse=True)
def small_scale(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_SCALE}
    for k, v in SMALL_SCALE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def third_on_one_key(column="id"):
    return F.when(F.col(column) % 3 == 0, 0).otherwise(F.col(column))


def rows(spark):
    return spark.range(0, ROWS, 1, 8)


def order_facts(spark, customer=None):
    stamp = F.timestamp_seconds(F.lit(1_500_000_000) + F.col("id") * 1000)
    return rows(spark).select(
        F.col("id").alias("order_id"),
        (customer if customer is not None else F.col("id")).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        stamp.alias("order_purchase_timestamp"),
        stamp.alias("order_approved_at"),
        stamp.alias("order_delivered_carrier_date"),
        stamp.alias("order_delivered_customer_date"),
        stamp.alias("order_estimated_delivery_date"),
        (F.col("id") % 5 - 2).cast("int").alias("delivery_delay_days"),
        (F.col("id") % 5 > 2).cast("int").alias("is_late"),
    )


def items(spark, **keys):
    base = {"order_id": F.col("id"), "product_id": F.col("id") % 500}
    columns = base | keys
    return rows(spark).select(
        *[c.alias(k) for k, c in columns.items()],
        F.lit(1).alias("order_item_id"),
        F.lit("s").alias("seller_id"),
        F.current_timestamp().alias("shipping_limit_date"),
        F.lit(1.5).alias("price"),
        F.lit(0.5).alias("freight_value"),
        F.lit(2.0).alias("total_item_value"),
    )


def split(df):
    df.write.format("noop").mode("overwrite").save()
    collected = df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString(), collected


def test_items_of_one_order(spark):
    was_split, out = split(fact_order_items(items(spark, order_id=third_on_one_key()), order_facts(spark)))
    assert was_split and len(out) == ROWS


def test_reviews_of_one_order(spark):
    tables = SimpleNamespace(
        fact_orders=order_facts(spark),
        fact_reviews=rows(spark).select(third_on_one_key().alias("order_id"), F.lit(4).alias("review_score")),
    )
    was_split, out = split(reviews.reviews_by_delivery_status(tables))
    assert was_split and sum(r["reviews"] for r in out) == ROWS


def test_orders_of_one_customer_by_month(spark):
    facts = order_facts(spark, customer=third_on_one_key())
    tables = SimpleNamespace(
        fact_orders=facts,
        delivery_features=facts.select("order_id", "customer_id", F.lit(2.0).alias("order_total_price")),
        dim_customers=rows(spark).select(
            F.col("id").alias("customer_id"), F.col("id").alias("customer_unique_id"), F.lit("S").alias("customer_state")
        ),
    )
    was_split, out = split(customers.monthly_customer_activity(tables))
    assert was_split and sum(r["orders"] for r in out) == ROWS


def test_orders_of_one_product(spark):
    tables = SimpleNamespace(
        fact_order_items=items(spark, product_id=third_on_one_key()),
        dim_products=rows(spark).select(
            F.col("id").alias("product_id"), F.concat(F.lit("c"), F.col("id") % 7).alias("product_category_name")
        ),
    )
    was_split, out = split(products.revenue_by_product_category(tables))
    assert was_split and sum(r["revenue"] for r in out) == 2.0 * ROWS


def test_sums_per_customer_are_combined_before_the_join(spark):
    facts = order_facts(spark, customer=third_on_one_key())
    tables = SimpleNamespace(
        delivery_features=facts.select("order_id", "customer_id", F.lit(2.0).alias("order_total_price")),
        dim_customers=rows(spark).select(
            F.col("id").alias("customer_id"), F.col("id").alias("customer_unique_id"), F.lit("S").alias("customer_state")
        ),
    )
    was_split, out = split(customers.customer_performance_by_state(tables))
    # Nothing is left to split: the busy customer reaches the join as one row.
    assert not was_split and out[0]["orders"] == ROWS and out[0]["revenue"] == 2.0 * ROWS
