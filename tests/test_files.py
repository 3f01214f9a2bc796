import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ordermill.catalog import QUERIES
from ordermill.operators.quality import DataQualityError
from ordermill.plans.layers import build_silver, run
from ordermill.plans.runner import ReportError, run_reports
from ordermill.plans.warehouse import GOLD_TABLES, StoredWarehouse
from ordermill.sources import files
from ordermill.sources.datasets import DATASETS
from rows import dicts

CSV = {
    "shop_orders_dataset.csv": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,\
order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 00:00:00,2018-01-09 00:00:00,2018-01-08 00:00:00
o2,c2,shipped,2018-01-03 10:00:00,,,,2018-01-12 00:00:00
o3,c3,delivered,2018-02-03 23:30:00,2018-02-04 00:00:00,2018-02-05 00:00:00,2018-02-06 00:00:00,2018-02-12 00:00:00
""",
    "shop_order_items_dataset.csv": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
o1,1,p1,s1,2018-01-05 00:00:00,10.50,1.25
o1,2,p2,s2,2018-01-05 00:00:00,20.00,2.00
o2,1,p1,s1,2018-01-07 00:00:00,10.50,1.25
o3,1,p1,s1,2018-02-07 00:00:00,11.00,1.00
o3,1,p1,s1,2018-02-07 00:00:00,11.00,1.00
""",
    "shop_customers_dataset.csv": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,01310, Sao Paulo ,sp
c2,u2,20000,rio,RJ
c3,u1,01310,sao paulo,SP
""",
    "shop_sellers_dataset.csv": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,a,sp\ns2,2,b,rj\n",
    "shop_products_dataset.csv": """product_id,product_category_name,product_name_lenght,product_description_lenght,\
product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,Toys,10,20,1,100,2,3,4
p2,,10,20,1,100,2,,4
""",
    "shop_order_reviews_dataset.csv": """review_id,order_id,review_score,review_comment_title,review_comment_message,\
review_creation_date,review_answer_timestamp
r1,o1,4,"Good, mostly","He said ""fine"",
then left",2018-01-10 00:00:00,2018-01-11 00:00:00
r2,o3,5,,,2018-02-10 00:00:00,2018-02-11 00:00:00
""",
    "shop_order_payments_dataset.csv": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,3,33.75
""",
    "shop_geolocation_dataset.csv": """geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,\
geolocation_state
1310,-23.5,-46.6,sao paulo,SP
1310,-23.5,-46.6,Sao Paulo,sp
""",
    "product_category_name_translation.csv": "product_category_name,product_category_name_english\nToys,toys\n",
}


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in CSV.items():
        (folder / name).write_text(text, encoding="utf-8")
    return folder


def test_quoted_text_with_breaks_commas_and_quotes(spark, raw):
    df = files.read_csv(spark, str(raw / "shop_order_reviews_dataset.csv"), DATASETS["order_reviews"])
    first = dicts(df, "review_id")[0]
    assert first["review_comment_message"] == 'He said "fine",\nthen left'
    assert first["review_comment_title"] == "Good, mostly"
    assert first["review_creation_date"] == datetime(2018, 1, 10)
    assert df.count() == 2


def test_malformed_fields_are_null_and_the_line_is_kept(spark, tmp_path):
    path = tmp_path / "order_payments.csv"
    path.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\no,x,card,1,2.5\n")
    df = files.read_csv(spark, str(path), DATASETS["order_payments"]).cache()
    assert dicts(df)[0] == {
        "order_id": "o", "payment_sequential": None, "payment_type": "card", "payment_installments": 1,
        "payment_value": 2.5, files.CORRUPT: "o,x,card,1,2.5",
    }
    assert files.rejected(df).count() == 1


def test_discovery_names(spark, raw):
    assert files.dataset_name("/x/shop_orders_dataset.csv", "shop_") == "orders"
    assert sorted(files.discover(spark, str(raw), "shop_")) == sorted(DATASETS)


def test_whole_run_from_csv_to_reports(spark, raw, tmp_path):
    out = str(tmp_path / "lake")
    gold = run(spark, str(raw), out, prefix="shop_")
    assert {len(dicts(gold.fact_orders)), len(dicts(gold.delivery_features))} == {3}
    history = {(r["order_id"], r["seller_id"]): r for r in dicts(gold.seller_performance)}
    assert history[("o3", "s1")]["seller_order_count"] == 2
    assert history[("o3", "s1")]["seller_late_rate"] == 0.5
    assert dicts(gold.fact_order_items.filter("order_id = 'o3'"))[0]["total_item_value"] == 12.0

    written = run_reports(gold, f"{out}/reports")
    assert len(written) == 26
    report = spark.read.option("header", True).csv(f"{out}/reports/sales/overall_sales_kpis")
    assert dicts(report)[0] == {
        "total_orders": "3", "total_revenue": "52.0", "average_order_value": "17.33",
        "minimum_order_value": "10.5", "maximum_order_value": "30.5",
    }
    months = spark.read.option("header", True).csv(f"{out}/reports/sales/monthly_sales_performance")
    assert [r["month"] for r in dicts(months)] == ["2018-01-01", "2018-02-01"]
    files.register_views(spark, f"{out}/gold", ["fact_orders"])
    assert spark.sql("SELECT count(*) FROM fact_orders WHERE is_late = 1").first()[0] == 1


def test_bad_silver_stops_the_run_before_gold(spark, raw, tmp_path):
    bad = CSV["shop_order_reviews_dataset.csv"].replace("r2,o3,5", "r2,o3,6")
    (raw / "shop_order_reviews_dataset.csv").write_text(bad)
    out = tmp_path / "lake"
    with pytest.raises(DataQualityError, match="invalid_review_scores: 1"):
        run(spark, str(raw), str(out), prefix="shop_")
    assert os.path.isdir(out / "silver") and not os.path.exists(out / "gold")


def test_every_file_is_ingested_and_none_twice(spark, raw, tmp_path):
    (raw / "shop_extra_dataset.csv").write_text("a,b\n1,x\n")
    written = files.ingest(spark, str(raw), str(tmp_path / "bronze"), "shop_")
    assert sorted(written) == sorted([*DATASETS, "extra"])
    assert dicts(files.read_table(spark, str(tmp_path / "bronze" / "extra"))) == [{"a": "1", "b": "x"}]
    (raw / "shop_orders.csv").write_text("order_id\n")
    with pytest.raises(ValueError, match="two files for table orders"):
        files.ingest(spark, str(raw), str(tmp_path / "bronze"), "shop_")


def test_a_missing_table_stops_the_run(spark, raw, tmp_path):
    (raw / "shop_geolocation_dataset.csv").rename(raw / "unrelated.txt")
    with pytest.raises(DataQualityError, match="missing raw tables: geolocation"):
        run(spark, str(raw), str(tmp_path / "lake"), prefix="shop_")


def test_rejected_lines_are_counted(spark, raw, tmp_path):
    path = raw / "shop_order_payments_dataset.csv"
    path.write_text(CSV[path.name] + "o2,x,card,1,2.5\n")
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    report = build_silver(spark, bronze, silver, files.ingest(spark, str(raw), bronze, "shop_"))
    counted = {r["dataset"]: r["violations"] for r in dicts(report.filter("check = 'rejected_lines'"))}
    assert counted["order_payments"] == 1 and sum(counted.values()) == 1 and len(counted) == 9


def test_failed_reports_do_not_stop_the_others(spark, tmp_path):
    def broken(tables):
        raise RuntimeError("no table")

    domains = {"d": {"bad": broken, "good": lambda tables: tables}}
    with pytest.raises(ReportError) as caught:
        run_reports(spark.range(2), str(tmp_path), domains)
    assert list(caught.value.failures) == ["d/bad"]
    assert spark.read.option("header", True).csv(str(tmp_path / "d" / "good")).count() == 2


def test_stored_warehouse_knows_its_tables(spark, tmp_path):
    with pytest.raises(AttributeError):
        StoredWarehouse(spark, str(tmp_path)).nonsense
    assert len(GOLD_TABLES) == 8


def test_json_sink(spark, tmp_path):
    path = str(tmp_path / "meta")
    files.write_json(spark.range(1).selectExpr("id", "struct(id as a) as s"), path)
    part = next(p for p in os.listdir(path) if p.endswith(".json"))
    assert json.loads(open(os.path.join(path, part)).read()) == {"id": 0, "s": {"a": 0}}


def test_catalogue_covers_the_reports():
    assert len(QUERIES) >= 26


def test_rejected_lines_without_records_of_them_and_with_a_limit(spark):
    plain = spark.createDataFrame([(1,)], "a int")
    marked = spark.createDataFrame([(1, None), (2, "x,y")], f"a int, {files.CORRUPT} string")
    rows = [files.rejected_lines(df, "t", most).first() for df in (plain, marked) for most in (None, 0, 1)]
    assert [(r["violations"], r["passed"]) for r in rows] == [(0, True)] * 3 + [(1, True), (1, False), (1, True)]


def test_a_lost_overwrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(5), path)
    lost = F.raise_error(F.lit("lost")).cast("long")
    half = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, lost).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        files.write_table(half, path)
    assert files.read_table(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]
    # An overwrite may read what it replaces.
    files.write_table(files.read_table(spark, path).filter("id > 2"), path)
    assert sorted(r.id for r in files.read_table(spark, path).collect()) == [3, 4]
    # Lost between the two renames: the table before is read, and the next overwrite puts things right.
    (tmp_path / "t").rename(tmp_path / "t.replaced")
    assert files.read_table(spark, path).count() == 2
    files.write_table(spark.range(7), path)
    assert files.read_table(spark, path).count() == 7
