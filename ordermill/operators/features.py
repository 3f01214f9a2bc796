"""One feature row per order: item totals, purchase time, seller history and the late flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import days_between, mean_of_rounded, money_sum


def order_item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("order_item_count"),
        money_sum("price").alias("order_total_price"),
        money_sum("freight_value").alias("order_total_freight"),
    )


def order_seller_history(seller_performance: DataFrame) -> DataFrame:
    """Seller history summarised per order.

    ``seller_performance`` holds every (order, seller) pair of a known order exactly once, so it is
    aggregated directly; joining the pairs to it again would shuffle both sides for nothing. A pair
    without a seller id has no history and is not counted; an order with no other pair has count 0. Rates and
    delays are rounded already, so the largest needs no rounding.
    """
    measures = ["seller_order_count", "seller_late_rate", "seller_avg_delivery_delay_days"]
    named = F.col("seller_id").isNotNull()
    known = seller_performance.withColumns({m: F.when(named, F.col(m)) for m in measures})
    return known.groupBy("order_id").agg(
        F.count("seller_id").alias("seller_count"),
        F.round(F.avg("seller_order_count"), 2).alias("seller_avg_order_count"),
        F.max("seller_order_count").alias("seller_max_order_count"),
        mean_of_rounded("seller_late_rate", 4).alias("seller_avg_late_rate"),
        F.max("seller_late_rate").alias("seller_max_late_rate"),
        mean_of_rounded("seller_avg_delivery_delay_days", 2).alias("seller_avg_delivery_delay_days"),
        F.max("seller_avg_delivery_delay_days").alias("seller_max_delivery_delay_days"),
    )


def delivery_features(orders: DataFrame, items: DataFrame, seller_performance: DataFrame) -> DataFrame:
    """Every order once; orders without items keep NULL item and seller features.

    Both joined sides are aggregates by ``order_id``, so the joins need no exchange of their own.
    """
    return (
        orders.join(order_item_totals(items), "order_id", "left")
        .join(order_seller_history(seller_performance), "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "order_status",
            "order_item_count",
            "order_total_price",
            "order_total_freight",
            F.hour("order_purchase_timestamp").alias("purchase_hour"),
            F.dayofweek("order_purchase_timestamp").alias("purchase_day_of_week"),
            days_between("order_estimated_delivery_date", "order_purchase_timestamp").alias(
                "estimated_delivery_duration_days"
            ),
            "seller_count",
            "seller_avg_order_count",
            "seller_max_order_count",
            "seller_avg_late_rate",
            "seller_max_late_rate",
            "seller_avg_delivery_delay_days",
            "seller_max_delivery_delay_days",
            "is_late",
        )
    )
