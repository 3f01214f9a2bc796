"""Profiling operators: what a dataset looks like before any rule is written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.columns import fractional_days, report_round, share
from ordermill.operators.dedup import repeated_rows
from ordermill.operators.quantiles import exact_quantiles
from ordermill.session import cut_lineage


def overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table, largest first."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("rows"), "dataset")


def schema_report(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Column names and types; read from the plans, no data is touched."""
    rows = [(name, i, c, dtype) for name, df in tables.items() for i, (c, dtype) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "dataset string, position int, column string, dtype string")


def _counted_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, present, n)``: one row per distinct value, counted before it is shuffled.

    Whole numbers and times stand for themselves, other values for 128 bits of theirs, so long texts are neither
    grouped by nor shuffled.
    """

    def entry(number: int, name: str) -> Column:
        kind, value = df.schema[name].dataType.typeName(), F.col(name)
        second = F.lit(None).cast("bigint")
        if kind in ("byte", "short", "integer", "long", "boolean"):
            first = value.cast("bigint")
        elif kind.startswith("timestamp"):
            first = F.unix_micros(value.cast("timestamp"))
        else:
            first, second = (F.when(value.isNotNull(), F.xxhash64(F.lit(seed), value)) for seed in (1, 2))
        return F.struct(F.lit(number).alias("number"), first.alias("first"), second.alias("second"))

    pairs = df.select(F.inline(F.array(*[entry(i, c) for i, c in enumerate(columns)])))
    counted = pairs.groupBy("number", "first", "second").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(c) for c in columns])
    return counted.select(names[F.col("number")].alias("column"), F.col("first").isNotNull().alias("present"), "n")


def column_metadata(df: DataFrame, dataset: str, approximate: bool = False) -> DataFrame:
    """Per column: type, missing count and percentage, number of distinct values.

    Exact counts come from one pass for all columns. ``approximate`` replaces them by a fixed-size
    sketch per column: no values are shuffled at all, for tables where an estimate will do.
    """
    rows = F.count(F.lit(1))
    if approximate:
        wide = df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        rows.alias("rows"),
                        F.count_if(F.col(c).isNull()).alias("missing_count"),
                        F.approx_count_distinct(c).alias("unique_count"),
                    )
                    for c in df.columns
                ]
            ).alias("_columns")
        )
        found = wide.select(F.inline("_columns"))
    else:
        found = (
            _counted_values(df, df.columns)
            .groupBy("column")
            .agg(
                F.sum("n").alias("rows"),
                F.coalesce(F.sum(F.when(~F.col("present"), F.col("n"))), F.lit(0)).alias("missing_count"),
                F.count_if("present").alias("unique_count"),
            )
        )
    types = F.create_map(*[F.lit(text) for pair in df.dtypes for text in pair])
    return found.select(
        F.lit(dataset).alias("dataset"),
        "column",
        types[F.col("column")].alias("dtype"),
        "missing_count",
        report_round(share(F.col("missing_count") * 100, F.col("rows")), 6).alias("missing_pct"),
        "unique_count",
    )


def all_columns(tables: dict[str, DataFrame], approximate: bool = False) -> DataFrame:
    return reduce(DataFrame.unionByName, [column_metadata(df, name, approximate) for name, df in tables.items()])


def missing_summary(metadata: DataFrame) -> DataFrame:
    """Columns with missing values, worst first within each table."""
    return metadata.filter(F.col("missing_count") > 0).orderBy("dataset", F.desc("missing_pct"), "column")


def columns_with_nulls(tables: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Columns that hold NULLs, for each table that has any: one aggregate a table, all in one job."""
    parts = [
        df.agg(F.array(*[F.when(F.count(c) < F.count(F.lit(1)), F.lit(c)) for c in df.columns]).alias("columns")).select(
            F.lit(name).alias("dataset"), F.array_compact("columns").alias("columns")
        )
        for name, df in tables.items()
    ]
    return {row.dataset: row.columns for row in reduce(DataFrame.unionByName, parts).collect() if row.columns}


def missing_values(tables: dict[str, DataFrame]) -> DataFrame:
    """The missing summary of raw tables. Distinct values are counted for columns with NULLs only."""
    found = columns_with_nulls(tables)
    if not found:
        name, df = next(iter(tables.items()))
        return missing_summary(column_metadata(df, name).filter(F.lit(False)))
    return missing_summary(all_columns({name: tables[name].select(*columns) for name, columns in found.items()}))


def duplicate_summary(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [repeated_rows(df).select(F.lit(name).alias("dataset"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value, most frequent first; NULL is a value of its own."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    total = counted.agg(F.sum("rows")).scalar()
    return counted.select(
        column, "rows", report_round(share(F.col("rows") * 100, total), 6).alias("percentage")
    ).orderBy(F.desc("rows"), F.asc_nulls_last(column))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, order_by: list[str], rows: int = 20) -> DataFrame:
    """The first rows in the given order: a top-k, not a sort of the table."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order_by]).limit(rows)


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Smallest, largest and mean value per column, in one pass."""
    wide = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.min(c).cast("double").alias("min_value"),
                    F.max(c).cast("double").alias("max_value"),
                    F.avg(c).cast("double").alias("avg_value"),
                )
                for c in columns
            ]
        ).alias("_columns")
    )
    return wide.select(F.inline("_columns"))


def key_cardinality(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rows against distinct values of key columns: ``{table: (df, keys)}``."""
    parts = [
        _counted_values(df, keys)
        .groupBy("column")
        .agg(F.sum("n").alias("rows"), F.count_if("present").alias("distinct_values"))
        .select(F.lit(name).alias("dataset"), "column", "rows", "distinct_values")
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _as_number(df: DataFrame, column: str) -> Column:
    """Timestamps as seconds since the epoch, other columns as doubles."""
    if df.schema[column].dataType.typeName().startswith("timestamp"):
        return F.unix_micros(F.col(column).cast("timestamp")) / F.lit(1_000_000.0)
    return F.col(column).cast("double")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles, one row per column.

    Timestamps are described in seconds since the epoch. The described columns are checkpointed,
    because exact quartiles take a few passes.
    """
    numbers = cut_lineage(df.select(*[_as_number(df, c).alias(c) for c in columns]))
    quartiles = exact_quantiles(numbers, columns, [0.25, 0.5, 0.75])
    wide = numbers.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(c).alias("count"),
                    F.avg(c).alias("mean"),
                    F.stddev_samp(c).alias("std"),
                    F.min(c).alias("min"),
                    *[F.lit(q).cast("double").alias(p) for p, q in zip(("p25", "p50", "p75"), quartiles[c])],
                    F.max(c).alias("max"),
                )
                for c in columns
            ]
        ).alias("_columns")
    )
    return wide.select(F.inline("_columns"))


def exploratory_delay(orders: DataFrame) -> DataFrame:
    """Delay in fractional days, and a two-valued late flag: an unknown delay is not late."""
    delay = fractional_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return orders.withColumn("delivery_delay_days", delay).withColumn(
        "is_late", F.coalesce(F.col("delivery_delay_days") > 0, F.lit(False))
    )


def seller_ranking(items: DataFrame, orders: DataFrame, top: int = 20) -> DataFrame:
    """Sellers by late rate over their whole history; a report, not a model feature."""
    outcome = exploratory_delay(orders).select("order_id", "delivery_delay_days", "is_late")
    pairs = items.select("order_id", "seller_id").distinct().join(outcome, "order_id", "left")
    # The pairs are distinct, so counting a seller's orders needs no second deduplication.
    return (
        pairs.filter(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(
            F.count("order_id").alias("orders"),
            report_round(F.avg(F.col("is_late").cast("int")), 6).alias("late_rate"),
            report_round(F.avg("delivery_delay_days"), 6).alias("avg_delay_days"),
        )
        .orderBy(F.desc_nulls_last("late_rate"), F.asc_nulls_last("seller_id"))
        .limit(top)
    )
