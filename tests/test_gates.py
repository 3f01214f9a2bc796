"""Gates counted while a layer is written, and gold tables in buckets."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators import risk
from ordermill.operators.quality import between, non_negative, not_null, required_columns, run_checks, unique, watch
from ordermill.plans.kpis.sales import monthly_sales_performance
from ordermill.plans.layers import build_gold, build_silver
from ordermill.plans.warehouse import CLEANERS, StoredWarehouse
from ordermill.sources.files import read_bucketed, read_table, write_table
from ordermill.sources.standin import raw_table
from rows import dicts

RULES = [
    required_columns(["k", "v", "gone"]),
    not_null("k"),
    unique(["k"]),
    non_negative("v"),
    between("v", 0, 5),
    non_negative("gone"),
    unique(["gone"]),
]
ROWS = [("a", 1), ("a", -2), (None, 9), (None, None), ("b", 5)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [ROWS, []])
def test_report_of_a_watched_write_is_that_of_the_written_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    watched, report = watch(spark.createDataFrame(rows, "k string, v int").repartition(3, "k"), "t", RULES)
    write_table(watched, path)
    expected = dicts(run_checks(read_table(spark, path), "t", RULES), "check", "violations")
    assert dicts(report(read_table(spark, path)), "check", "violations") == expected
    assert len(expected) == len(RULES)


def test_row_rules_do_not_read_the_written_table(spark, tmp_path):
    path = str(tmp_path / "t")
    watched, report = watch(spark.createDataFrame(ROWS, "k string, v int"), "t", [not_null("k"), non_negative("v")])
    write_table(watched, path)
    found = report(read_table(spark, path))
    assert "FileScan" not in plan(found)
    assert [(r["check"], r["violations"], r["passed"]) for r in found.collect()] == [
        ("k_not_null", 2, False),
        ("v_non_negative", 1, False),
    ]


def test_uniqueness_rules_read_their_keys_once(spark, tmp_path):
    path = str(tmp_path / "t")
    watched, report = watch(spark.createDataFrame(ROWS, "k string, v int"), "t", RULES)
    write_table(watched, path)
    text = plan(report(read_table(spark, path)))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<k:string>" in text


def test_bucketed_table_is_overwritten_and_leaves_the_catalog(spark, tmp_path):
    path = str(tmp_path / "it's a table")
    tables = []
    for n in (50, 70):
        write_table(spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).repartition(3, "k"), path, "k", 3)
        df = read_bucketed(spark, path)
        assert sorted(map(tuple, df.collect())) == [(i, 2 * i) for i in range(n)]
        assert sorted(map(tuple, read_table(spark, path).collect())) == [(i, 2 * i) for i in range(n)]
        tables.append({t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")})
    assert len(tables[1] - tables[0]) == 1 and not tables[0] - tables[1] <= tables[1]


def test_lost_bucketed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5).repartition(2, "id"), path, "id", 2)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error("lost")).otherwise(F.col("id")).cast("bigint").alias("id"))
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Exception, match="lost"):
        write_table(broken.repartition(2, "id"), path, "id", 2)
    assert sorted(r["id"] for r in read_bucketed(spark, path).collect()) == list(range(5))
    assert {t.name for t in spark.catalog.listTables()} >= before
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.fixture(scope="module")
def lake(spark, tiny, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gates"))
    for name in CLEANERS:
        write_table(raw_table(spark, tiny, name), f"{root}/bronze/{name}")
    silver = build_silver(spark, f"{root}/bronze", f"{root}/silver", list(CLEANERS))
    gold = build_gold(spark, f"{root}/silver", f"{root}/gold", buckets=5)
    return root, silver, gold


def test_layer_reports_equal_the_suites_on_stored_tables(spark, lake):
    from ordermill.operators.suites import GOLD_SUITES, SILVER_SUITES

    root, silver, gold = lake
    for layer, suites, report in (("silver", SILVER_SUITES, silver), ("gold", GOLD_SUITES, gold)):
        got = [r for r in dicts(report, "dataset", "check") if r["check"] != "rejected_lines"]
        expected = [
            row
            for name in sorted(suites)
            for row in dicts(run_checks(read_table(spark, f"{root}/{layer}/{name}"), name, suites[name]), "check")
        ]
        assert got == expected


def test_joins_of_order_tables_need_no_shuffle_of_them(spark, lake):
    tables = StoredWarehouse(spark, f"{lake[0]}/gold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        training = risk.training_set(tables.by_order("delivery_features"), tables.by_order("fact_orders"))
        assert "Exchange" not in plan(training)
        assert plan(training).count("SelectedBucketsCount: 5 out of 5") == 2
        plain = risk.training_set(tables.delivery_features, tables.fact_orders)
        assert "Exchange" in plan(plain)
        assert dicts(training, "order_id") == dicts(plain, "order_id")
        report = plan(monthly_sales_performance(tables))
        # Only months are shuffled (partial sums by month, then the order of the report).
        assert "hashpartitioning(order_id" not in report
        assert report.count("Bucketed: true") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
