import pytest

from ordermill.operators import quality as q
from ordermill.operators.clean import clean_category_translation, clean_geolocation
from ordermill.operators.suites import check_gold, check_silver
from rows import dicts, item, order, star


def found(report):
    return {r["check"]: r["violations"] for r in dicts(report)}


def test_every_kind_of_rule(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.5), ("a", -1, 1.2), (None, 2, -0.1), ("b", None, None)], "k string, n int, rate double"
    )
    rules = [
        q.required_columns(["k", "gone"]),
        q.not_null("k"),
        q.unique(["k"]),
        q.unique(["k", "n"]),
        q.non_negative("n"),
        q.between("rate", 0.0, 1.0),
        q.allowed("n", [1, -1]),
        q.not_null("gone"),
    ]
    report = q.run_checks(df, "t", rules)
    assert found(report) == {
        "required_columns": 1, "k_not_null": 1, "k_unique": 1, "k_n_unique": 0, "n_non_negative": 1,
        "rate_between": 2, "n_allowed": 1, "gone_not_null": None,
    }
    passed = {r["check"] for r in dicts(report) if r["passed"]}
    assert passed == {"k_n_unique"}


def test_enforce_lists_failures_and_accepts_clean_reports(spark):
    df = spark.createDataFrame([(1,), (None,)], "n int")
    q.enforce(q.run_checks(df, "t", [q.non_negative("n")]))
    with pytest.raises(q.DataQualityError, match="t.n_not_null: 1"):
        q.enforce(q.run_checks(df, "t", [q.not_null("n")]))


def test_an_empty_table_passes(spark):
    df = spark.createDataFrame([], "n int")
    assert found(q.run_checks(df, "t", [q.not_null("n"), q.unique(["n"])])) == {"n_not_null": 0, "n_unique": 0}


def test_review_scores_and_geolocation_bounds(spark):
    reviews = spark.createDataFrame(
        [("r1", "o", 0), ("r2", "o", 6), ("r3", None, None), (None, "o", 5)],
        "review_id string, order_id string, review_score int",
    )
    assert found(check_silver(reviews, "order_reviews")) == {
        "invalid_review_scores": 2, "null_review_ids": 1, "null_order_ids": 1,
    }
    geo = spark.createDataFrame(
        [(1, 91.0, 0.0, "a", "A"), (1, -91.0, 0.0, "a", "A"), (None, 0.0, 181.0, "a", "A")],
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    assert found(check_silver(clean_geolocation(geo), "geolocation")) == {
        "invalid_latitude": 2, "invalid_longitude": 1, "null_zip_prefix": 1,
    }


def test_translation_and_zip_suites(spark):
    words = spark.createDataFrame(
        [("a", "x"), ("a", "y"), (None, None)], "product_category_name string, product_category_name_english string"
    )
    name = "product_category_name_translation"
    assert found(check_silver(words, name)) == {
        "duplicate_categories": 1, "null_categories": 1, "null_english_names": 1,
    }
    q.enforce(check_silver(clean_category_translation(words.filter("product_category_name = 'a'")), name))
    zips = spark.createDataFrame([("a", -1), ("b", None)], "seller_id string, seller_zip_code_prefix int")
    assert found(check_silver(zips, "sellers"))["invalid_zip_prefixes"] == 1


def test_gold_suites_find_impossible_values(spark):
    tables = star(spark, [order("o1", delay=1), order("o2", day=1)], [item("o1"), item("o2")])
    for name in ("fact_orders", "fact_order_items", "seller_performance", "delivery_features"):
        q.enforce(check_gold(getattr(tables, name), name))
    flags = tables.fact_orders.selectExpr("* except (is_late)", "2 as is_late")
    assert found(check_gold(flags, "fact_orders"))["is_late_allowed"] == 2
    rates = tables.seller_performance.selectExpr("* except (seller_late_rate)", "1.2D as seller_late_rate")
    assert found(check_gold(rates, "seller_performance"))["seller_late_rate_between"] == 2
    assert found(check_gold(tables.fact_orders.drop("is_late"), "fact_orders"))["required_columns"] == 1


def test_missing_references_ignore_null_keys_and_report_them(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert dicts(q.missing_references(child, "fk", parent, "pk", "c")) == [
        {"check": "c", "violations": 1, "null_keys": 2}
    ]


def test_one_row_per_order(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "order_id string")
    assert found(q.one_row_per_order(df, "t")) == {"one_row_per_order": 1}


def test_chronology(spark):
    tables = star(spark, [order("ok", delay=1), order("back", delay=-20), order("open")], [item("ok")])
    assert found(q.chronology_rules(tables.fact_orders)) == {
        "delivered_before_purchase": 1, "missing_delivered_date": 1, "missing_estimated_date": 0,
    }
