from datetime import datetime

import numpy as np
import pytest

from ordermill.operators import profile
from rows import dicts, item, order, star


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(
        [
            (1, "a", 0.5, True, datetime(2018, 1, 1)),
            (1, "a", 0.5, True, datetime(2018, 1, 1)),
            (2, "a", None, None, datetime(2018, 1, 2)),
            (3, None, 0.0, False, None),
            (3, None, -0.0, False, None),
        ],
        "n int, s string, d double, b boolean, t timestamp",
    )


def test_column_metadata(mixed):
    rows = {r["column"]: r for r in dicts(profile.column_metadata(mixed, "m"))}
    assert {c: (r["dtype"], r["missing_count"], r["unique_count"]) for c, r in rows.items()} == {
        "n": ("int", 0, 3), "s": ("string", 2, 1), "d": ("double", 1, 2), "b": ("boolean", 1, 2),
        "t": ("timestamp", 2, 2),
    }
    assert rows["s"]["missing_pct"] == 40.0
    estimated = {r["column"]: r["unique_count"] for r in dicts(profile.column_metadata(mixed, "m", approximate=True))}
    assert estimated["n"] == 3 and estimated["s"] == 1


def test_missing_summary_order(mixed):
    found = dicts(profile.missing_summary(profile.column_metadata(mixed, "m")))
    assert [r["column"] for r in found] == ["s", "t", "b", "d"]


def test_duplicates_and_overview(mixed):
    # Minus zero and zero are one value, so two pairs of rows repeat.
    assert dicts(profile.duplicate_summary({"m": mixed})) == [
        {"dataset": "m", "rows": 5, "duplicate_rows": 2, "duplicate_pct": 40.0}
    ]
    assert dicts(profile.overview({"m": mixed, "big": mixed.union(mixed)})) == [
        {"dataset": "big", "rows": 10, "columns": 5}, {"dataset": "m", "rows": 5, "columns": 5},
    ]


def test_repeated_keys(mixed):
    from ordermill.operators.dedup import repeated_keys

    assert {(r["n"], r["count"]) for r in dicts(repeated_keys(mixed, ["n"]))} == {(1, 2), (3, 2)}


def test_schema_report(spark, mixed):
    rows = dicts(profile.schema_report(spark, {"m": mixed}))
    assert [(r["position"], r["column"], r["dtype"]) for r in rows][:2] == [(0, "n", "int"), (1, "s", "string")]


def test_null_is_a_value_in_distributions(mixed):
    assert dicts(profile.value_distribution(mixed, "s")) == [
        {"s": "a", "rows": 3, "percentage": 60.0}, {"s": None, "rows": 2, "percentage": 40.0},
    ]
    assert {(r["n"], r["rows"]) for r in dicts(profile.value_counts(mixed, "n"))} == {(1, 2), (2, 1), (3, 2)}


def test_key_cardinality(mixed):
    rows = {r["column"]: (r["rows"], r["distinct_values"]) for r in dicts(profile.key_cardinality({"m": (mixed, ["n", "s"])}))}
    assert rows == {"n": (5, 3), "s": (5, 1)}


def test_describe_matches_numpy(spark):
    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0]
    df = spark.createDataFrame([(v, datetime(2018, 1, int(v))) for v in values] + [(None, None)], "x double, t timestamp")
    rows = {r["column"]: r for r in dicts(profile.describe(df, ["x", "t"]))}
    x = rows["x"]
    assert x["count"] == 7 and x["mean"] == pytest.approx(np.mean(values)) and x["std"] == pytest.approx(np.std(values, ddof=1))
    assert [x["min"], x["p25"], x["p50"], x["p75"], x["max"]] == list(np.quantile(values, [0, 0.25, 0.5, 0.75, 1]))
    assert rows["t"]["p50"] == datetime(2018, 1, 3).timestamp() - datetime(1970, 1, 1).timestamp()


def test_summary_and_exploratory_delay(spark):
    tables = star(spark, [order("a", delay=1.25), order("b", delay=-0.5), order("c")], [item("a"), item("a", "z", price=4.0)])
    assert dicts(profile.numeric_summary(tables.fact_order_items, ["price"])) == [
        {"column": "price", "min_value": 4.0, "max_value": 10.0, "avg_value": 7.0}
    ]
    rows = {r["order_id"]: r for r in dicts(profile.exploratory_delay(tables.fact_orders))}
    assert {k: (r["delivery_delay_days"], r["is_late"]) for k, r in rows.items()} == {
        "a": (1.25, True), "b": (-0.5, False), "c": (None, False),
    }


def test_seller_ranking_uses_the_whole_history(spark):
    orders = [order("a", delay=1), order("b", delay=-1), order("c")]
    tables = star(spark, orders, [item("a", "x"), item("b", "x"), item("c", "x"), item("a", "y"), item("gone", "z")])
    rows = {r["seller_id"]: r for r in dicts(profile.seller_ranking(tables.fact_order_items, tables.fact_orders))}
    assert (rows["x"]["orders"], rows["x"]["late_rate"], rows["x"]["avg_delay_days"]) == (3, 0.333333, 0.0)
    assert rows["y"]["late_rate"] == 1.0 and rows["z"]["late_rate"] is None


def test_missing_values_equal_the_summary_of_all_columns(mixed):
    full = mixed.select("n")
    tables = {"full": full, "m": mixed}
    assert profile.columns_with_nulls(tables) == {"m": ["s", "d", "b", "t"]}
    assert dicts(profile.missing_values(tables)) == dicts(profile.missing_summary(profile.all_columns(tables)))
    assert profile.missing_values({"full": full}).collect() == []
    assert profile.missing_values({"none": mixed.limit(0)}).collect() == []


def test_a_null_in_another_column_is_another_row(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None), (None, None)], "x string, y string")
    assert [r["duplicate_rows"] for r in dicts(profile.duplicate_summary({"t": df, "none": df.limit(0)}))] == [1, 0]
