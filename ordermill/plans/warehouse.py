"""Lazy access to every table of the model, built on the fly or read from a stored layer."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ordermill.operators import clean, features, history, star
from ordermill.sources.files import read_bucketed, read_table

CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": clean.clean_customers,
    "sellers": clean.clean_sellers,
    "products": clean.clean_products,
    "orders": clean.clean_orders,
    "order_items": clean.clean_order_items,
    "order_payments": clean.clean_payments,
    "order_reviews": clean.clean_reviews,
    "geolocation": clean.clean_geolocation,
    "product_category_name_translation": clean.clean_category_translation,
}

# In build order: the seller history reads two facts, the features read the history.
GOLD_TABLES = [
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "fact_orders",
    "fact_order_items",
    "fact_reviews",
    "seller_performance",
    "delivery_features",
]

# Tables with one row per order, stored in buckets of ``order_id``. The key is unique, so no bucket can be hot;
# items, history and reviews, where it isn't, stay plain and their joins can be split by adaptive execution.
ORDER_TABLES = ["fact_orders", "delivery_features"]


class Warehouse:
    """Star-schema tables as DataFrames, each planned once and only when asked for.

    ``silver(name)`` supplies a cleaned table. Nothing runs here: Spark sees one plan per query and
    prunes the columns, joins and windows the query does not use.
    """

    def __init__(self, silver: Callable[[str], DataFrame]):
        self._silver = silver
        self._cleaned: dict[str, DataFrame] = {}

    @classmethod
    def from_raw(cls, raw: Callable[[str], DataFrame]) -> Warehouse:
        return cls(lambda name: CLEANERS[name](raw(name)))

    def silver(self, name: str) -> DataFrame:
        if name not in self._cleaned:
            self._cleaned[name] = self._silver(name)
        return self._cleaned[name]

    @cached_property
    def dim_customers(self) -> DataFrame:
        return star.dim_customers(self.silver("customers"))

    @cached_property
    def dim_products(self) -> DataFrame:
        return star.dim_products(self.silver("products"))

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return star.dim_sellers(self.silver("sellers"))

    @cached_property
    def fact_orders(self) -> DataFrame:
        return star.fact_orders(self.silver("orders"))

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return star.fact_order_items(self.silver("order_items"), self.silver("orders"))

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return star.fact_reviews(self.silver("order_reviews"))

    @cached_property
    def seller_performance(self) -> DataFrame:
        return history.seller_performance(self.fact_order_items, self.fact_orders)

    @cached_property
    def delivery_features(self) -> DataFrame:
        return features.delivery_features(self.fact_orders, self.fact_order_items, self.seller_performance)


class StoredWarehouse:
    """The same tables read from a written gold layer."""

    def __init__(self, spark: SparkSession, gold_dir: str):
        self._spark = spark
        self._dir = gold_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in GOLD_TABLES:
            raise AttributeError(name)
        return read_table(self._spark, f"{self._dir}/{name}")

    def by_order(self, name: str) -> DataFrame:
        """The table scanned by its buckets of ``order_id``. For joins of two tables of ``ORDER_TABLES`` only: a join
        with any other table would shuffle that one alone, and could not be split at a hot key any more.
        """
        return read_bucketed(self._spark, f"{self._dir}/{name}") if name in ORDER_TABLES else getattr(self, name)


def by_order(tables, name: str) -> DataFrame:
    """A table of ``ORDER_TABLES`` for a join with another one: by buckets where it is stored so, else as it is."""
    return tables.by_order(name) if isinstance(tables, StoredWarehouse) else getattr(tables, name)
