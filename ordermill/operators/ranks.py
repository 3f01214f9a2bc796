"""Running totals over one order of all rows, without bringing the rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.session import cut_lineage


def _earlier_sums(window, measures: list[str], prefix: str) -> list[Column]:
    return [F.coalesce(F.sum(m).over(window), F.lit(0)).alias(f"{prefix}{m}") for m in measures]


def sums_before(df: DataFrame, order: Column, measures: list[str]) -> DataFrame:
    """``df`` with ``before_<m>``, the sum of each measure over all rows earlier in ``order``; rows must not tie.

    Rows are dealt into ranges of the order and stored once, with the range's number. A window runs inside each
    range; the totals of earlier ranges, one row a range, are added.
    """
    ranges = cut_lineage(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("_range").agg(*[F.sum(m).alias(m) for m in measures])
    over = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_range", *_earlier_sums(over, measures, "_over_"))
    placed = ranges.select("*", *_earlier_sums(inside, measures, "_in_")).join(F.broadcast(totals), "_range")
    return placed.select(*df.columns, *[(F.col(f"_in_{m}") + F.col(f"_over_{m}")).alias(f"before_{m}") for m in measures])
