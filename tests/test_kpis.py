from datetime import datetime
from types import SimpleNamespace

from ordermill.plans.kpis import customers, delivery, products, reviews, sales, sellers
from ordermill.catalog import QUERIES
from rows import START, dicts, item, order, star


def people(spark, pairs):
    return spark.createDataFrame(
        [(c, p, 1, "city", state) for c, p, state in pairs],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, "
        "customer_state string",
    )


def test_customer_segments(spark):
    orders, ids = [], []
    for size in range(1, 7):
        for n in range(size):
            name = f"{size}-{n}"
            orders.append(order(name, day=n, customer=name))
            ids.append((name, f"person{size}", "SP" if size < 6 else "RJ"))
    tables = star(spark, orders, [item(o[0], price=2.5) for o in orders])
    tables.dim_customers = people(spark, ids)
    assert dicts(customers.customers_by_number_of_orders(tables)) == [
        {"customer_segment": "1 order", "customers": 1},
        {"customer_segment": "2-3 orders", "customers": 2},
        {"customer_segment": "4-5 orders", "customers": 2},
        {"customer_segment": "6+ orders", "customers": 1},
    ]
    assert dicts(customers.overall_customer_kpis(tables)) == [
        {"total_customers": 6, "total_orders": 21, "orders_per_customer": 3.5, "revenue_per_customer": 8.75}
    ]
    assert dicts(customers.customer_performance_by_state(tables)) == [
        {"customer_state": "SP", "customers": 5, "orders": 15, "revenue": 37.5, "average_order_value": 2.5},
        {"customer_state": "RJ", "customers": 1, "orders": 6, "revenue": 15.0, "average_order_value": 2.5},
    ]
    assert dicts(customers.monthly_customer_activity(tables)) == [
        {"month": datetime(2018, 1, 1), "active_customers": 6, "orders": 21, "revenue": 52.5}
    ]


def test_delivery_denominators_differ(spark):
    tables = star(
        spark, [order("a", delay=4), order("b", delay=-1), order("c"), order("d", status="delivered")], [item("a")]
    )
    overall = dicts(delivery.overall_delivery_kpis(tables))[0]
    assert (overall["total_orders"], overall["late_delivery_rate"]) == (4, 25.0)
    assert (overall["avg_delivery_delay_days"], overall["avg_estimated_delivery_days"]) == (1.0, 10.0)
    month = dicts(delivery.delivery_performance_by_month(tables))[0]
    assert (month["orders"], month["late_rate_percentage"], month["avg_delivery_days"]) == (4, 50.0, 11.5)
    by_status = {r["order_status"]: r for r in dicts(delivery.delivery_performance_by_order_status(tables))}
    # A delivered order without a date counts as 0 days late; other statuses have no averages.
    assert by_status["delivered"]["avg_delay_days"] == 1.33
    assert by_status["shipped"]["avg_delay_days"] is None and by_status["shipped"]["avg_delivery_days"] is None


def seller_rows(spark, rows):
    return SimpleNamespace(
        seller_performance=spark.createDataFrame(
            rows,
            "order_id string, seller_id string, seller_order_count long, seller_late_order_count long, "
            "seller_late_rate double, seller_avg_delivery_delay_days double",
        )
    )


def test_ranking_needs_twenty_prior_orders(spark):
    tables = seller_rows(spark, [("o", f"s{n}", n, 1, 0.5, 1.0) for n in (19, 20, 21)])
    assert [r["seller_id"] for r in dicts(delivery.late_deliveries_by_seller(tables))] == ["s20", "s21"]
    assert [r["seller_id"] for r in dicts(sellers.worst_sellers_by_late_rate(tables))] == ["s20", "s21"]
    assert [r["seller_id"] for r in dicts(sellers.top_sellers_by_orders(tables))] == ["s21", "s20", "s19"]


def test_ties_at_the_cut_are_broken_by_key(spark):
    rows = [("o", f"s{n:02}", 30, 3, 0.1, 1.0) for n in range(25)]
    expected = [f"s{n:02}" for n in range(20)]
    for shuffled in (rows, rows[::-1]):
        tables = seller_rows(spark, shuffled)
        assert [r["seller_id"] for r in dicts(sellers.worst_sellers_by_late_rate(tables))] == expected


def test_a_seller_without_a_rate_is_poor(spark):
    tables = seller_rows(
        spark,
        [("o", "none", 0, None, None, None), ("o", "good", 9, 1, 0.1, 0.0), ("o", "best", 9, 0, 0.0999, 0.0),
         ("o", "fair", 9, 2, 0.2, 0.0), ("o", "bad", 9, 3, 0.3, 0.0)],
    )
    assert dicts(sellers.seller_performance_distribution(tables)) == [
        {"seller_performance": "Average (20-30%)", "sellers": 1},
        {"seller_performance": "Excellent (<10%)", "sellers": 1},
        {"seller_performance": "Good (10-20%)", "sellers": 1},
        {"seller_performance": "Poor (30%+)", "sellers": 2},
    ]


def test_categories_with_no_name_or_no_value(spark):
    tables = star(
        spark,
        [order("a"), order("b")],
        [item("a", product="p1", price=30.0, freight=10.0), item("a", number=2, product="p2"),
         item("b", product="p1", price=30.0, freight=10.0), item("b", number=2, product="free", price=0.0, freight=0.0)],
    )
    tables.dim_products = spark.createDataFrame(
        [("p1", "toys"), ("p2", None), ("free", "gifts")], "product_id string, product_category_name string"
    )
    assert dicts(products.revenue_by_product_category(tables)) == [
        {"category": "toys", "orders": 2, "products": 1, "revenue": 80.0, "average_price": 30.0},
        {"category": "Unknown", "orders": 1, "products": 1, "revenue": 11.0, "average_price": 10.0},
        {"category": "gifts", "orders": 1, "products": 1, "revenue": 0.0, "average_price": 0.0},
    ]
    assert dicts(products.freight_performance_by_category(tables)) == [
        {"category": "toys", "average_freight": 10.0, "freight_percentage": 25.0},
        {"category": "Unknown", "average_freight": 1.0, "freight_percentage": 9.09},
        {"category": "gifts", "average_freight": 0.0, "freight_percentage": None},
    ]
    assert dicts(products.overall_product_kpis(tables)) == [
        {"total_products": 3, "average_product_price": 17.5, "total_product_revenue": 91.0,
         "total_freight_revenue": 21.0}
    ]
    top = dicts(products.top_products_by_revenue(tables))
    assert [(r["product_id"], r["orders"], r["revenue"]) for r in top] == [("p1", 2, 80.0), ("p2", 1, 11.0), ("free", 1, 0.0)]


def test_reviews_of_open_orders_count_as_on_time(spark):
    tables = star(spark, [order("a", delay=4), order("b", delay=0), order("c")], [item("a")])
    tables.fact_reviews = spark.createDataFrame(
        [("r1", "a", 1, START), ("r2", "b", 5, START), ("r3", "c", 4, START), ("r4", "gone", 4, START)],
        "review_id string, order_id string, review_score int, review_creation_date timestamp",
    )
    assert dicts(reviews.reviews_by_delivery_status(tables)) == [
        {"delivery_status": "Late", "reviews": 1, "average_review_score": 1.0},
        {"delivery_status": "On Time", "reviews": 2, "average_review_score": 4.5},
    ]
    assert dicts(reviews.review_score_distribution(tables)) == [
        {"review_score": 1, "reviews": 1, "percentage": 25.0},
        {"review_score": 4, "reviews": 2, "percentage": 50.0},
        {"review_score": 5, "reviews": 1, "percentage": 25.0},
    ]
    by_score = {r["review_score"]: r for r in dicts(reviews.review_score_vs_delivery_performance(tables))}
    assert by_score[1]["average_delivery_delay"] == 4.0 and by_score[4]["late_delivery_rate"] is None


def test_unknown_outcomes_come_last_in_sales(spark):
    tables = star(spark, [order("a", delay=4), order("b", delay=0), order("c")], [item("a"), item("c", price=7.0)])
    assert dicts(sales.late_orders_impact_on_sales(tables)) == [
        {"is_late": 0, "total_orders": 1, "total_revenue": None, "average_order_value": None},
        {"is_late": 1, "total_orders": 1, "total_revenue": 10.0, "average_order_value": 10.0},
        {"is_late": None, "total_orders": 1, "total_revenue": 7.0, "average_order_value": 7.0},
    ]
    overall = dicts(sales.overall_sales_kpis(tables))[0]
    assert (overall["minimum_order_value"], overall["maximum_order_value"]) == (7.0, 10.0)


def total(rows, column):
    return sum(r[column] for r in rows)


def test_totals_agree_across_reports(spark, tiny):
    def run(name):
        return dicts(QUERIES[name](spark, tiny))

    orders = run("overall_sales_kpis")[0]["total_orders"]
    assert total(run("late_orders_impact_on_sales"), "total_orders") == orders
    assert total(run("late_delivery_by_purchase_day"), "orders") == orders
    assert total(run("sales_by_order_status"), "total_orders") == orders
    assert run("overall_delivery_kpis")[0]["total_orders"] == orders
    people_total = run("overall_customer_kpis")[0]["total_customers"]
    assert total(run("customers_by_number_of_orders"), "customers") == people_total
    sellers_total = run("overall_seller_kpis")[0]["total_sellers"]
    assert total(run("seller_performance_distribution"), "sellers") == sellers_total
    written = run("overall_review_kpis")[0]["total_reviews"]
    assert total(run("review_score_distribution"), "reviews") == written
    assert total(run("review_score_by_month"), "reviews") == written
    known = [r for r in run("late_orders_impact_on_sales") if r["is_late"] is not None]
    summary = run("training_summary")[0]
    assert total(known, "total_orders") == summary["rows"] == summary["late_orders"] + summary["on_time_orders"]
    assert summary["rows"] + summary["removed_missing_target"] == orders


def test_money_is_rounded_after_the_sum_and_nan_is_reported(spark):
    from ordermill.operators.suites import check_silver
    from ordermill.operators.clean import clean_order_items
    from rows import ITEM_SCHEMA

    items = [item("o", number=i, price=1.005, freight=0.0) for i in range(3)]
    tables = star(spark, [order("o")], items)
    assert dicts(tables.delivery_features)[0]["order_total_price"] == 3.02
    odd = [*items, item("o", number=9, price=float("nan")), item("o", number=10, price=1e300)]
    tables = star(spark, [order("o")], odd)
    assert dicts(tables.delivery_features)[0]["order_total_price"] == 3.02
    assert dicts(products.overall_product_kpis(tables))[0]["average_product_price"] == 1.01
    silver = clean_order_items(spark.createDataFrame(odd, ITEM_SCHEMA))
    report = {r["check"]: r["violations"] for r in dicts(check_silver(silver, "order_items"))}
    assert report["unusable_prices"] == 2 and report["unusable_freight"] == 0
