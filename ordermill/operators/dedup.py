"""Duplicate handling that no single key can overload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest(columns: list[str | Column], seed: int = 0) -> Column:
    """64 bits of the values, other ones for another ``seed``. NULL is a value; minus zero is zero."""
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(F.lit(seed), *[part for c in values for part in (c.isNull(), c)])


def keep_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the one with the smallest digest of its other columns; of a single other column, its
    smallest value, NULL first.

    The choice depends on the rows only, so repartitioning the input never changes it. It is an
    aggregate rather than a ranking window: every map task reduces a repeated key (or a flood of
    NULL keys) to one row before the shuffle. Texts are picked one by one, so a text that nobody
    reads is hashed where it is scanned but not shuffled. Catalyst also learns that the result is unique
    by ``keys`` and can drop joins to it that nobody reads from.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    if len(rest) == 1:
        picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).getField(rest[0]).alias(rest[0]))
        return picked.select(*df.columns)
    texts = [c for c in rest if df.schema[c].dataType.typeName() == "string"]
    others = [c for c in rest if c not in texts]
    parts = [F.min_by(c, "_digest").alias(c) for c in texts]
    if others:
        parts.append(F.min_by(F.struct(*others), "_digest").alias("_others"))
    picked = df.withColumn("_digest", digest(rest)).groupBy(*keys).agg(*parts)
    return picked.select(*[F.col(f"_others.{c}").alias(c) if c in others else F.col(c) for c in df.columns])


def repeated_rows(df: DataFrame) -> DataFrame:
    """One row: total rows, fully repeated rows beyond the first, and their percentage."""
    # Rows are told apart by 128 bits, so what is shuffled doesn't grow with their width.
    counted = df.groupBy(digest(df.columns, 1), digest(df.columns, 2)).agg(F.count(F.lit(1)).alias("_copies"))
    rows = F.coalesce(F.sum("_copies"), F.lit(0))
    extra = F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0))
    return counted.agg(
        rows.alias("rows"),
        extra.alias("duplicate_rows"),
        F.try_divide(extra * F.lit(100.0), rows).alias("duplicate_pct"),
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
