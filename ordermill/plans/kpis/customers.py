"""Customer KPIs. People are counted by ``customer_unique_id``; an order's customer id is per order.

``delivery_features`` has one row per order and ``dim_customers`` one per customer id, so orders are
counted, not counted distinct. Orders are summed per customer id before the join: the join needs
that shuffle anyway, and a customer with very many orders reaches it as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import amount, money, money_mean, money_sum, month_of, report_round, share
from ordermill.plans.warehouse import by_order


def _orders_per_customer(tables) -> DataFrame:
    totals = tables.delivery_features.groupBy("customer_id").agg(
        F.count("order_id").alias("n"),
        F.sum(amount("order_total_price")).alias("revenue"),
        F.count("order_total_price").alias("priced"),
    )
    people = tables.dim_customers.select("customer_id", "customer_unique_id", "customer_state")
    return totals.join(people, "customer_id")


def overall_customer_kpis(tables) -> DataFrame:
    people = F.countDistinct("customer_unique_id")
    orders = F.coalesce(F.sum("n"), F.lit(0))
    return _orders_per_customer(tables).agg(
        people.alias("total_customers"),
        orders.alias("total_orders"),
        report_round(share(orders, people)).alias("orders_per_customer"),
        money_mean(F.sum("revenue"), people).alias("revenue_per_customer"),
    )


def customer_performance_by_state(tables) -> DataFrame:
    return (
        _orders_per_customer(tables)
        .groupBy("customer_state")
        .agg(
            F.countDistinct("customer_unique_id").alias("customers"),
            F.sum("n").alias("orders"),
            money(F.sum("revenue")).alias("revenue"),
            money_mean(F.sum("revenue"), F.sum("priced")).alias("average_order_value"),
        )
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("customer_state"))
    )


def customers_by_number_of_orders(tables) -> DataFrame:
    orders = F.sum("n")
    segment = (
        F.when(orders == 1, "1 order")
        .when(orders.between(2, 3), "2-3 orders")
        .when(orders.between(4, 5), "4-5 orders")
        .otherwise("6+ orders")
    )
    return (
        _orders_per_customer(tables)
        .groupBy("customer_unique_id")
        .agg(segment.alias("customer_segment"))
        .groupBy("customer_segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        # The labels were chosen to sort in segment order.
        .orderBy("customer_segment")
    )


def monthly_customer_activity(tables) -> DataFrame:
    months = by_order(tables, "fact_orders").select("order_id", month_of("order_purchase_timestamp").alias("month"))
    people = tables.dim_customers.select("customer_id", "customer_unique_id")
    return (
        by_order(tables, "delivery_features").select("order_id", "customer_id", "order_total_price")
        .join(months, "order_id")
        .join(people, "customer_id")
        .groupBy("month")
        .agg(
            F.countDistinct("customer_unique_id").alias("active_customers"),
            F.count("order_id").alias("orders"),
            money_sum("order_total_price").alias("revenue"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


QUERIES = {
    "overall_customer_kpis": overall_customer_kpis,
    "customer_performance_by_state": customer_performance_by_state,
    "customers_by_number_of_orders": customers_by_number_of_orders,
    "monthly_customer_activity": monthly_customer_activity,
}
