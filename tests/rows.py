"""Hand-made tables for unit tests."""

from __future__ import annotations

from datetime import datetime, timedelta
from types import SimpleNamespace

from ordermill.operators.clean import clean_order_items, clean_orders
from ordermill.operators.features import delivery_features
from ordermill.operators.history import seller_performance
from ordermill.operators.star import fact_order_items, fact_orders

ORDER_SCHEMA = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)
ITEM_SCHEMA = (
    "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, "
    "price double, freight_value double"
)
START = datetime(2018, 1, 7, 10, 0)  # a Sunday


def order(order_id, day=0.0, delay=None, customer="c", status=None, estimate_days=10):
    """An order placed ``day`` days after START, delivered ``delay`` days after its estimate."""
    placed = START + timedelta(days=day)
    estimated = placed + timedelta(days=estimate_days)
    delivered = None if delay is None else estimated + timedelta(days=delay)
    status = status or ("shipped" if delay is None else "delivered")
    return (order_id, customer, status, placed, placed, placed, delivered, estimated)


def item(order_id, seller="s", number=1, product="p", price=10.0, freight=1.0):
    return (order_id, number, product, seller, START, price, freight)


def star(spark, orders, items, block_rows=None):
    """The star schema over hand-made orders and items."""
    silver_orders = clean_orders(spark.createDataFrame(orders, ORDER_SCHEMA))
    silver_items = clean_order_items(spark.createDataFrame(items, ITEM_SCHEMA))
    facts = fact_orders(silver_orders)
    fact_items = fact_order_items(silver_items, silver_orders)
    extra = {} if block_rows is None else {"block_rows": block_rows}
    history = seller_performance(fact_items, facts, **extra)
    return SimpleNamespace(
        fact_orders=facts,
        fact_order_items=fact_items,
        seller_performance=history,
        delivery_features=delivery_features(facts, fact_items, history),
    )


def dicts(df, *order_by):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order_by)) if order_by else rows
