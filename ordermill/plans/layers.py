"""The layered run: raw CSV to bronze, silver and gold, with a quality gate after each of the last two."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ordermill.operators.quality import DataQualityError, enforce, watch
from ordermill.operators.suites import GOLD_SUITES, SILVER_SUITES
from ordermill.plans.warehouse import CLEANERS, GOLD_TABLES, ORDER_TABLES, StoredWarehouse, Warehouse
from ordermill.sources.files import CORRUPT, ingest, read_table, rejected_lines, write_table


def build_silver(
    spark: SparkSession, bronze_dir: str, silver_dir: str, tables: list[str], most_rejected: int | None = None
) -> DataFrame:
    """Clean, write and check every table: row rules while it is written, uniqueness on what was written. Returns the
    report, with lines that had malformed fields counted for each table; more than ``most_rejected`` of them fail.
    All tables of the model are needed.
    """
    missing = sorted(set(CLEANERS) - set(tables))
    if missing:
        raise DataQualityError(f"missing raw tables: {', '.join(missing)}")
    tables = [name for name in tables if name in CLEANERS]
    reports = []
    for name in tables:
        raw, path = read_table(spark, f"{bronze_dir}/{name}"), f"{silver_dir}/{name}"
        cleaned, report = watch(CLEANERS[name](raw.drop(CORRUPT)), name, SILVER_SUITES[name])
        write_table(cleaned, path)
        reports.append(report(read_table(spark, path)))
    reports += [rejected_lines(read_table(spark, f"{bronze_dir}/{name}"), name, most_rejected) for name in tables]
    return reduce(DataFrame.unionByName, reports)


class _GoldBuilder(Warehouse):
    """Gold definitions that read gold tables already written, so nothing is computed twice."""

    def __init__(self, spark: SparkSession, silver_dir: str, gold_dir: str, buckets: int):
        super().__init__(lambda name: read_table(spark, f"{silver_dir}/{name}"))
        self._spark = spark
        self._gold_dir = gold_dir
        self._buckets = buckets

    def write(self, name: str) -> DataFrame | None:
        """Write a table; the report of its suite, if it has one."""
        path = f"{self._gold_dir}/{name}"
        table, key = getattr(self, name), None
        if name in ORDER_TABLES:
            key = "order_id"
            table = table.repartition(self._buckets, key)
        report = None
        if name in GOLD_SUITES:
            table, report = watch(table, name, GOLD_SUITES[name])
        write_table(table, path, key, self._buckets)
        # Later tables of the layer are planned on the written one.
        self.__dict__[name] = read_table(self._spark, path)
        return report(self.__dict__[name]) if report else None


def build_gold(spark: SparkSession, silver_dir: str, gold_dir: str, buckets: int | None = None) -> DataFrame:
    """Write the star schema in dependency order and check it as ``build_silver`` does. Returns the report.

    Tables with one row per order get ``buckets`` buckets of ``order_id``, by default as many as Spark has shuffle
    partitions; choose them so that one fits a task.
    """
    builder = _GoldBuilder(spark, silver_dir, gold_dir, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    reports = [builder.write(name) for name in GOLD_TABLES]
    return reduce(DataFrame.unionByName, [r for r in reports if r is not None])


def run(spark: SparkSession, raw_dir: str, out_dir: str, prefix: str = "", buckets: int | None = None) -> StoredWarehouse:
    """All layers under ``out_dir``; stops before gold unless every silver check passes."""
    bronze, silver, gold = (f"{out_dir}/{layer}" for layer in ("bronze", "silver", "gold"))
    tables = ingest(spark, raw_dir, bronze, prefix)
    enforce(build_silver(spark, bronze, silver, tables))
    enforce(build_gold(spark, silver, gold, buckets))
    return StoredWarehouse(spark, gold)
