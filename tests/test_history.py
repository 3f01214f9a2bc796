import random
from collections import defaultdict
from datetime import timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ordermill.operators import history
from rows import START, dicts, item, order, star


def rounded(numerator, denominator, places):
    if not denominator:
        return None
    exact = Decimal(numerator) / Decimal(denominator)
    return float(exact.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def brute_force(orders, items):
    """History by a plain loop over each seller's sorted orders."""
    by_id = {o[0]: o for o in orders}
    sellers = defaultdict(set)
    for i in items:
        if i[0] in by_id:
            sellers[i[3]].add(i[0])
    out = {}
    for seller, ids in sellers.items():
        n = late = known = delay = 0
        for oid in sorted(ids, key=lambda x: (by_id[x][3], x)):
            out[(oid, seller)] = (
                n, late if known else None, rounded(late, n, 4) if known else None, rounded(delay, known, 2),
            )
            o = by_id[oid]
            n += 1
            if o[6] is not None:
                days = (o[6].date() - o[7].date()).days
                known, delay, late = known + 1, delay + days, late + (days > 0)
    return out


def measured(history):
    return {
        (r["order_id"], r["seller_id"]): (
            r["seller_order_count"], r["seller_late_order_count"], r["seller_late_rate"],
            r["seller_avg_delivery_delay_days"],
        )
        for r in dicts(history)
    }


def random_shop(seed, n=150):
    rng = random.Random(seed)
    orders = [
        order(f"o{i:03}", day=rng.choice([0, 0.0003, 0.5, 1, 2, 3]) + rng.random() * rng.choice([0, 0.01, 4]),
              delay=rng.choice([None, -3, 0, 1, 5]))
        for i in range(n)
    ]
    # One seller takes about half of all rows.
    items = [
        item(f"o{rng.randrange(n + 5):03}", seller=rng.choice(["hot"] * 4 + ["a", "b", "c", None]), number=j)
        for j in range(3 * n)
    ]
    return orders, items


@pytest.mark.parametrize("block_rows", [None, 20, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force_with_few_and_many_blocks(spark, seed, block_rows):
    orders, items = random_shop(seed)
    tables = star(spark, orders, items, block_rows)
    assert measured(tables.seller_performance) == brute_force(orders, items)


def test_a_seller_with_one_purchase_time_is_still_cut_into_blocks(spark):
    rng = random.Random(9)
    ids = [f"{rng.getrandbits(64):016x}" for _ in range(200)]
    orders = [order(i, delay=rng.choice([None, -1, 2])) for i in ids[:150]]
    orders += [order(i, delay=1)[:3] + (None,) + order(i, delay=1)[4:] for i in ids[150:]]  # no purchase time
    items = [item(i, "hot") for i in ids] + [item(i, None) for i in ids[:40]]
    got = measured(star(spark, orders, items, 25).seller_performance)
    epoch = [o[:3] + (o[3] or START - timedelta(days=9999),) + o[4:] for o in orders]  # unknown times come first
    assert got == brute_force(epoch, items)


@pytest.mark.parametrize("n, block_rows, expected", [(20_000, 500, 40), (1_000_000, 200, 1131)])
def test_blocks_are_even_for_one_seller_one_time_and_ids_with_a_common_lead(spark, n, block_rows, expected):
    sold = spark.range(n).select(F.format_string("ORDER-2024-%08d", "id").alias("order_id"), F.lit("s").alias("seller_id"))
    orders = sold.select(
        "order_id",
        F.lit(START).cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(0).alias("delivery_delay_days"),
        F.lit(0).alias("is_late"),
    )
    blocks = history._in_blocks(history._with_seller_key(sold), orders, block_rows)
    sizes = [r["count"] for r in blocks.groupBy("_super", "_block").count().collect()]
    assert sum(sizes) == n and 0.9 * expected <= len(sizes) <= 1.15 * expected
    assert max(sizes) <= 2 * n / len(sizes)
    per_order = history.seller_performance(sold, orders, block_rows).select("order_id", "seller_order_count")
    wrong = per_order.filter("seller_order_count != cast(substring(order_id, 12) as long)")
    assert wrong.count() == 0


def test_sellers_of_some_hundred_orders_are_not_cut_and_need_no_totals(spark):
    sold = spark.range(12_000).select(F.col("id").alias("order_id"), (F.col("id") % 20).alias("seller_id"))
    orders = sold.select(
        "order_id",
        F.lit(START).cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(0).alias("delivery_delay_days"),
        F.lit(0).alias("is_late"),
    )
    blocks = history._in_blocks(history._with_seller_key(sold), orders, history.LEAST_BLOCK_ROWS)
    assert blocks.select("_seller", "_super", "_block").distinct().count() == 20
    rows = history.seller_performance(sold, orders)
    assert rows.filter("seller_order_count != floor(order_id / 20)").count() == 0 and rows.count() == 12_000


def test_an_order_of_unknown_sellers_only_counts_none(spark):
    orders, items = [order("x"), order("y", day=1)], [item("x", None), item("y", None), item("y", "a", number=2)]
    rows = {r["order_id"]: r for r in dicts(star(spark, orders, items).delivery_features)}
    assert rows["x"]["seller_count"] == 0 and rows["y"]["seller_count"] == 1
    assert rows["x"]["seller_max_order_count"] is None and rows["y"]["seller_max_order_count"] == 0


def test_numeric_order_ids_and_short_blocks(spark, tiny):
    from ordermill.operators.history import seller_performance
    from ordermill.plans.warehouse import Warehouse
    from ordermill.sources.standin import raw_table

    tables = Warehouse.from_raw(lambda name: raw_table(spark, tiny, name))
    plain = measured(tables.seller_performance)
    assert measured(seller_performance(tables.fact_order_items, tables.fact_orders, block_rows=7)) == plain


def test_first_order_unknown_outcomes_and_ties(spark):
    orders = [
        order("t1", delay=1), order("t2", delay=None), order("t3", day=1, delay=0),  # t1 and t2 tie
        order("u1"), order("u2", day=1), order("one", delay=2),
    ]
    items = [item(o, "tied") for o in ("t1", "t2", "t3")] + [item(o, "open") for o in ("u1", "u2")] + [item("one", "solo")]
    got = measured(star(spark, orders, items).seller_performance)
    assert got[("t1", "tied")] == (0, None, None, None)
    assert got[("t2", "tied")] == (1, 1, 1.0, 1.0)
    assert got[("t3", "tied")] == (2, 1, 0.5, 1.0)  # the undelivered order counts below the line only
    assert got[("u2", "open")] == (1, None, None, None)
    assert got[("one", "solo")] == (0, None, None, None)


def test_history_never_looks_ahead(spark):
    orders, items = random_shop(3)
    before = measured(star(spark, orders, items, 10).seller_performance)
    later = orders + [order("z", day=30, delay=9)]
    after = measured(star(spark, later, items + [item("z", "hot"), item("z", "a")], 10).seller_performance)
    assert {k: v for k, v in after.items() if k[0] != "z"} == before


def test_history_does_not_depend_on_partitioning(spark):
    orders, items = random_shop(4)
    first = measured(star(spark, orders, items, 10).seller_performance)
    random.Random(0).shuffle(items)
    assert measured(star(spark, orders[::-1], items, 10).seller_performance) == first


def test_feature_row_per_order(spark):
    late = order("two", day=2, delay=3)
    orders = [order("a1", delay=1), order("b1", day=1, delay=-2), late, order("none", day=6)]
    items = [
        item("a1", "A"), item("b1", "B"),
        item("two", "A", price=0.1, freight=0.2), item("two", "B", number=2, price=0.2), item("two", "B", number=3),
    ]
    rows = {r["order_id"]: r for r in dicts(star(spark, orders, items).delivery_features)}
    assert len(rows) == 4
    two = rows["two"]
    assert (two["order_item_count"], two["order_total_price"], two["order_total_freight"]) == (3, 10.3, 2.2)
    assert (two["seller_count"], two["seller_avg_order_count"], two["seller_max_order_count"]) == (2, 1.0, 1)
    assert (two["seller_avg_late_rate"], two["seller_max_late_rate"]) == (0.5, 1.0)
    assert (two["seller_avg_delivery_delay_days"], two["seller_max_delivery_delay_days"]) == (-0.5, 1.0)
    assert (two["purchase_hour"], two["purchase_day_of_week"], two["estimated_delivery_duration_days"]) == (10, 3, 10)
    empty = rows["none"]
    assert empty["order_item_count"] is None and empty["seller_count"] is None and empty["is_late"] is None
    assert empty["purchase_day_of_week"] == 7 and rows["a1"]["purchase_day_of_week"] == 1


def test_purchase_hours(spark):
    shift = -START.hour / 24
    orders = [order("h0", day=shift), order("h23", day=shift + 23 / 24)]
    rows = {r["order_id"]: r["purchase_hour"] for r in dicts(star(spark, orders, [item("h0")]).delivery_features)}
    assert rows == {"h0": 0, "h23": 23}
    assert START + timedelta(days=shift) == START.replace(hour=0)
