"""The stored layers over the test tables: gates, and every report against its SQL."""

import pytest

import __spark_entry__ as contract
from oracle_check import connect, differences
from ordermill.plans.kpis import DOMAINS
from ordermill.plans.layers import build_gold, build_silver
from ordermill.plans.warehouse import CLEANERS, GOLD_TABLES, StoredWarehouse
from ordermill.sources.files import write_table
from ordermill.sources.standin import raw_table
from rows import dicts

TABLES = list(CLEANERS)
REPORTS = {name: query for queries in DOMAINS.values() for name, query in queries.items()}


@pytest.fixture(scope="module")
def lake(spark, tiny, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    for name in TABLES:
        write_table(raw_table(spark, tiny, name), f"{root}/bronze/{name}")
    silver = dicts(build_silver(spark, f"{root}/bronze", f"{root}/silver", TABLES))
    gold = dicts(build_gold(spark, f"{root}/silver", f"{root}/gold"))
    return {"silver": silver, "gold": gold, "tables": StoredWarehouse(spark, f"{root}/gold")}


def test_only_the_repeated_line_numbers_of_the_test_data_fail(lake):
    failed = [(r["dataset"], r["check"]) for r in lake["silver"] if not r["passed"]]
    assert failed == [("order_items", "duplicate_order_item_records")]
    assert all(r["passed"] for r in lake["gold"])


@pytest.fixture(scope="module")
def duck(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", GOLD_TABLES)
def test_stored_table_matches_sql(lake, duck, name):
    assert differences(getattr(lake["tables"], name), duck, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_on_stored_tables_matches_sql(lake, duck, name):
    assert differences(REPORTS[name](lake["tables"]), duck, contract.oracle_sql()[name]) == []
