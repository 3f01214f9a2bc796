from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ordermill.operators import clean
from ordermill.operators.star import fact_orders
from rows import ITEM_SCHEMA, ORDER_SCHEMA, dicts, item, order

CUSTOMERS = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
    "customer_state string"
)


def test_place_names_are_normalised(spark):
    df = spark.createDataFrame([("a", "p", "01310", "  Sao PAULO ", " sp")], CUSTOMERS)
    row = clean.clean_customers(df).first()
    assert (row.customer_city, row.customer_state, row.customer_zip_code_prefix) == ("sao paulo", "SP", 1310)


@pytest.mark.parametrize("flip", [False, True])
def test_survivor_of_a_repeated_key_does_not_depend_on_input_order(spark, flip):
    rows = [("a", "p", "2", "x", "SP"), ("a", "p", "1", "y", "SP"), ("b", "q", None, "z", "RJ")]
    df = spark.createDataFrame(rows[::-1] if flip else rows, CUSTOMERS).repartition(3)
    kept = {r.customer_id: r.customer_city for r in clean.clean_customers(df).collect()}
    assert kept == {"a": "y", "b": "z"}


def test_null_keys_collapse_to_one_row(spark):
    df = spark.createDataFrame([(None, "p", "2", "x", "SP"), (None, "q", "1", "y", "SP")], CUSTOMERS)
    assert clean.clean_customers(df).count() == 1


def test_malformed_values_become_null_and_never_raise(spark):
    schema = ORDER_SCHEMA.replace("timestamp timestamp", "timestamp string").replace(" timestamp,", " string,")
    schema = schema.replace("order_estimated_delivery_date timestamp", "order_estimated_delivery_date string")
    df = spark.createDataFrame(
        [
            ("o1", "c", "shipped", "2018-01-01 10:00:00", "not a time", "", None, "2018-01-05 00:00:00"),
        ],
        schema,
    )
    row = clean.clean_orders(df).first()
    assert row.order_purchase_timestamp == datetime(2018, 1, 1, 10)
    assert (row.order_approved_at, row.order_delivered_carrier_date, row.delivery_delay_days) == (None, None, None)
    bad = spark.createDataFrame([("a", "p", "12x", "c", "s"), ("b", "p", "", "c", "s")], CUSTOMERS)
    assert [r.customer_zip_code_prefix for r in clean.clean_customers(bad).collect()] == [None, None]


def test_delays_and_both_late_flags(spark):
    orders = [order("on", delay=0), order("early", delay=-1), order("late", delay=1), order("open")]
    midnight = order("midnight")
    estimated = datetime(2018, 1, 17, 0, 0)
    orders.append(midnight[:6] + (datetime(2018, 1, 16, 23, 59), estimated))
    silver = clean.clean_orders(spark.createDataFrame(orders, ORDER_SCHEMA))
    gold = fact_orders(silver)
    assert {r.order_id: (r.delivery_delay_days, r.is_late) for r in silver.collect()} == {
        "on": (0, 0), "early": (-1, 0), "late": (1, 1), "open": (None, 0), "midnight": (-1, 0),
    }
    assert {r.order_id: r.is_late for r in gold.collect()} == {
        "on": 0, "early": 0, "late": 1, "open": None, "midnight": 0,
    }
    assert {r.order_id: r.delivery_duration_days for r in gold.collect()}["late"] == 11


def test_items_drop_bad_amounts_and_exact_duplicates(spark):
    rows = [item("o"), item("o"), item("o", price=None), item("o", freight=-1.0), item("o", number=2, freight=0.0)]
    kept = dicts(clean.clean_order_items(spark.createDataFrame(rows, ITEM_SCHEMA)), "order_item_id")
    assert [(r["order_item_id"], r["total_item_value"]) for r in kept] == [(1, 11.0), (2, 10.0)]


def test_product_volume_is_null_when_a_side_is_missing(spark):
    names = ", ".join(f"{c} string" for c in clean.PRODUCT_MEASURES)
    df = spark.createDataFrame(
        [("a", " Toys ", "1", "1", "1", "5", "2", "3", "4"), ("b", None, "1", "1", "1", "5", "2", None, "4")],
        f"product_id string, product_category_name string, {names}",
    )
    rows = {r.product_id: (r.product_category_name, r.product_volume_cm3) for r in clean.clean_products(df).collect()}
    assert rows == {"a": ("toys", 24.0), "b": (None, None)}


def test_payments_reviews_geolocation_and_translation(spark):
    pay = spark.createDataFrame(
        [("o", "1", " Credit_Card ", "3", "9.5"), ("o", "1", "credit_card", "3", "9.5")],
        "order_id string, payment_sequential string, payment_type string, payment_installments string, "
        "payment_value string",
    )
    assert dicts(clean.clean_payments(pay)) == [
        {"order_id": "o", "payment_sequential": 1, "payment_type": "credit_card", "payment_installments": 3,
         "payment_value": 9.5}
    ]
    reviews = spark.createDataFrame(
        [("r", "o", "5", " Good ", " Very GOOD ", "2018-01-01 00:00:00", None), ("r", "o2", "x", None, None, None, None)],
        "review_id string, order_id string, review_score string, review_comment_title string, "
        "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    )
    got = dicts(clean.clean_reviews(reviews), "order_id")
    assert [(r["order_id"], r["review_score"], r["review_comment_message"]) for r in got] == [
        ("o", 5, "Very GOOD"), ("o2", None, None),
    ]
    geo = spark.createDataFrame(
        [("1", "-1.5", "2", " A ", "sp "), ("1", "-1.50", "2.0", "a", "SP")],
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, "
        "geolocation_city string, geolocation_state string",
    )
    assert clean.clean_geolocation(geo).count() == 1
    words = spark.createDataFrame(
        [(" Flores", "Flowers"), ("flores ", "flowers ")],
        "product_category_name string, product_category_name_english string",
    )
    assert dicts(clean.clean_category_translation(words)) == [
        {"product_category_name": "flores", "product_category_name_english": "flowers"}
    ]


def test_money_sums_are_exact(spark):
    from ordermill.functions.columns import money_sum

    df = spark.range(10).select(F.lit(0.1).alias("x"))
    assert df.agg(money_sum("x")).first()[0] == 1.0
