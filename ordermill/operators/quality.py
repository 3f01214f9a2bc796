"""Declarative data-quality checks.

All row rules of a table are counters in one aggregate, which shuffles a single row per task. Each
uniqueness rule counts rows per key, combined before the shuffle, so a key with very many rows is no
burden; it reads the key columns only. Counters are deliberately not carried along with the keys: a
second columnar scan is far cheaper than shuffling a dozen counters per key.

A table that is being written needs no scan for its row rules: ``watch`` has the writing job count them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class DataQualityError(ValueError):
    """At least one check found violations."""


@dataclass(frozen=True)
class Rule:
    """``condition`` builds the violation predicate; a rule with ``unique`` counts repeated keys.

    ``condition`` is a function so that rules can be declared before a session exists.
    """

    name: str
    columns: tuple[str, ...]
    condition: Callable[[], Column] | None = None
    unique: bool = False


def rule(name: str, columns: Sequence[str], condition: Callable[[], Column]) -> Rule:
    return Rule(name, tuple(columns), condition)


def required_columns(names: Sequence[str]) -> Rule:
    """Violations: required columns that the table does not have."""
    return Rule("required_columns", tuple(names))


def not_null(column: str, name: str | None = None) -> Rule:
    return rule(name or f"{column}_not_null", [column], lambda: F.col(column).isNull())


def unique(columns: Sequence[str], name: str | None = None) -> Rule:
    """Violations: keys that occur more than once."""
    return Rule(name or "_".join(columns) + "_unique", tuple(columns), unique=True)


def at_least(column: str, minimum: float, name: str | None = None) -> Rule:
    """NULL is allowed."""
    return rule(name or f"{column}_at_least_{minimum}", [column], lambda: F.col(column) < minimum)


def non_negative(column: str, name: str | None = None) -> Rule:
    return at_least(column, 0, name or f"{column}_non_negative")


def between(column: str, low: float, high: float, name: str | None = None) -> Rule:
    """Inclusive bounds; NULL is allowed."""
    return rule(name or f"{column}_between", [column], lambda: ~F.col(column).between(low, high))


def allowed(column: str, values: Iterable, name: str | None = None) -> Rule:
    """NULL is allowed."""
    listed = list(values)
    return rule(name or f"{column}_allowed", [column], lambda: ~F.col(column).isin(listed))


def same_value(column: str, expected: Callable[[], Column], tolerance: float, name: str, uses: Sequence[str]) -> Rule:
    """A derived column must equal its definition up to ``tolerance``."""
    return rule(name, [column, *uses], lambda: F.abs(F.col(column) - expected()) >= tolerance)


def _missing(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def _repeated_keys(df: DataFrame, r: Rule) -> DataFrame:
    keys = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("_rows"))
    repeated = keys.agg(F.count_if(F.col("_rows") > 1).alias("violations"))
    return repeated.select(F.lit(r.name).alias("check"), "violations")


def _split(df: DataFrame, rules: Sequence[Rule]) -> tuple[list[Rule], list[Rule]]:
    """Uniqueness rules that can be evaluated, and all others."""
    keyed = [r for r in rules if r.unique and not _missing(df, r.columns)]
    return keyed, [r for r in rules if r not in keyed]


def _counter(df: DataFrame, r: Rule) -> Column:
    missing = _missing(df, r.columns)
    if r.condition is None and not r.unique:
        return F.lit(len(missing))
    return F.lit(None) if missing else F.count_if(r.condition())


def _report(dataset: str, parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(dataset).alias("dataset"),
        "check",
        "violations",
        F.coalesce(F.col("violations") == 0, F.lit(False)).alias("passed"),
    )


def run_checks(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """``(dataset, check, violations, passed)``, one row per rule.

    A rule over a column the table lacks cannot be evaluated: NULL violations, not passed.
    """
    keyed, counted = _split(df, rules)
    parts = [_repeated_keys(df, r) for r in keyed]
    if counted:
        wide = df.agg(
            F.array(
                *[
                    F.struct(F.lit(r.name).alias("check"), _counter(df, r).cast("bigint").alias("violations"))
                    for r in counted
                ]
            ).alias("_checks")
        )
        parts.append(wide.select(F.inline("_checks")))
    return _report(dataset, parts)


def watch(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` to be written as it is returned, and a function from the written table to the report of ``run_checks``.

    The job that writes counts the violations of row rules, so that only uniqueness rules read the table again, and
    of that the key columns. Write without another shuffle in between: counters of a job's last stage take in
    every task once, however often it was tried. Where no counters come back (Spark may plan an empty table
    without any job), the written table is checked.
    """
    keyed, counted = _split(df, rules)
    evaluated = {f"_check_{i}": r for i, r in enumerate(counted) if not _missing(df, r.columns)}
    if not evaluated:
        return df, lambda written: run_checks(written, dataset, rules)
    seen = Observation()
    watched = df.observe(seen, *[_counter(df, r).cast("bigint").alias(name) for name, r in evaluated.items()])

    def report(written: DataFrame) -> DataFrame:
        counts = seen.get
        if set(counts) != set(evaluated):
            return run_checks(written, dataset, rules)
        found = {r.name: counts[name] for name, r in evaluated.items()}
        # One row a rule, known before any job runs.
        rows = [(r.name, found.get(r.name, len(_missing(df, r.columns)) if r.condition is None and not r.unique else None)) for r in counted]
        parts = [_repeated_keys(written, r) for r in keyed]
        return _report(dataset, [*parts, df.sparkSession.createDataFrame(rows, "check string, violations bigint")])

    return watched, report


def enforce(report: DataFrame) -> None:
    """Raise if any check failed. The report has one row per rule, so reading it here is safe."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        listing = "; ".join(f"{row['dataset']}.{row['check']}: {row['violations']}" for row in failed)
        raise DataQualityError(listing)


def missing_references(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Distinct non-NULL child keys without a parent row, and child rows whose key is NULL.

    Child keys are reduced to distinct values with their row counts first, so a key that fills a
    large part of the table is one row in the join.
    """
    keys = child.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    joined = keys.join(known, F.col("_key") == F.col("_parent"), "left")
    orphan = F.col("_key").isNotNull() & F.col("_parent").isNull()
    return joined.agg(
        F.lit(name).alias("check"),
        F.count_if(orphan).alias("violations"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0)).alias("null_keys"),
    ).select("check", "violations", "null_keys")


def referential_integrity(
    orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame, sellers: DataFrame
) -> DataFrame:
    parts = [
        missing_references(orders, "customer_id", customers, "customer_id", "orders_customer_id"),
        missing_references(items, "product_id", products, "product_id", "order_items_product_id"),
        missing_references(items, "seller_id", sellers, "seller_id", "order_items_seller_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def chronology_rules(orders: DataFrame) -> DataFrame:
    """Delivered before purchased (delivered orders only), and how many outcome dates are unknown."""
    delivered = F.col("order_delivered_customer_date")
    return run_checks(
        orders,
        "orders",
        [
            rule(
                "delivered_before_purchase",
                ["order_delivered_customer_date", "order_purchase_timestamp"],
                lambda: delivered < F.col("order_purchase_timestamp"),
            ),
            not_null("order_delivered_customer_date", "missing_delivered_date"),
            not_null("order_estimated_delivery_date", "missing_estimated_date"),
        ],
    )


def one_row_per_order(df: DataFrame, dataset: str) -> DataFrame:
    """Rows against distinct order ids, as a check row; fails when they differ."""
    keys = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("_rows"))
    surplus = F.coalesce(F.sum("_rows") - F.count(F.lit(1)), F.lit(0))
    return keys.agg(surplus.alias("violations")).select(
        F.lit(dataset).alias("dataset"),
        F.lit("one_row_per_order").alias("check"),
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )
