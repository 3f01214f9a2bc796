"""Every query by name, each a function of (session, folder of test tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.columns import report_round
from ordermill.operators import profile, quality, risk
from ordermill.operators.clean import clean_orders
from ordermill.operators.suites import check_gold, check_silver
from ordermill.plans.kpis import DOMAINS
from ordermill.plans.warehouse import CLEANERS, GOLD_TABLES, Warehouse
from ordermill.sources.standin import orders_as_text, raw_table

Query = Callable[[SparkSession, str], DataFrame]


class _Source:
    """Raw tables of one folder, and the warehouse planned over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir
        self._raw: dict[str, DataFrame] = {}
        self.warehouse = Warehouse.from_raw(self.raw)

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = raw_table(self.spark, self._dir, name)
        return self._raw[name]

    def all_raw(self) -> dict[str, DataFrame]:
        return {name: self.raw(name) for name in CLEANERS}


def _on(build: Callable[[_Source], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_Source(spark, sf_dir))


def _rounded(df: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    """Means of doubles depend on summation order from about the 14th digit on, fitted weights from the 7th; cut before."""
    return df.withColumns({c: report_round(df[c], places) for c in columns})


_CLEAN = {
    "clean_customers": "customers",
    "clean_sellers": "sellers",
    "clean_products": "products",
    "clean_orders": "orders",
    "clean_order_items": "order_items",
    "clean_payments": "order_payments",
    "clean_reviews": "order_reviews",
    "clean_geolocation": "geolocation",
    "clean_category_translation": "product_category_name_translation",
}


def _cleaned(table: str) -> Query:
    return _on(lambda s: s.warehouse.silver(table))


def _orders_from_text(s: _Source) -> DataFrame:
    cleaned = clean_orders(orders_as_text(s.raw("orders")))
    times = [f.name for f in cleaned.schema.fields if f.dataType.typeName() == "timestamp"]
    return cleaned.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _gold(table: str) -> Query:
    return _on(lambda s: getattr(s.warehouse, table))


def _kpi(query: Callable[..., DataFrame]) -> Query:
    return _on(lambda s: query(s.warehouse))


def _silver_check(table: str) -> Query:
    return _on(lambda s: check_silver(s.warehouse.silver(table), table))


def _gold_check(table: str) -> Query:
    return _on(lambda s: check_gold(getattr(s.warehouse, table), table))


def _integrity(s: _Source) -> DataFrame:
    return quality.referential_integrity(
        s.raw("orders"), s.raw("order_items"), s.raw("customers"), s.raw("products"), s.raw("sellers")
    )


def _cardinality(s: _Source) -> DataFrame:
    return profile.key_cardinality(
        {
            "customers": (s.raw("customers"), ["customer_id"]),
            "order_items": (s.raw("order_items"), ["order_id", "product_id", "seller_id"]),
            "orders": (s.raw("orders"), ["order_id", "customer_id"]),
            "products": (s.raw("products"), ["product_id"]),
            "sellers": (s.raw("sellers"), ["seller_id"]),
        }
    )


def _exploratory(s: _Source) -> DataFrame:
    return profile.exploratory_delay(s.raw("orders"))


def _training(s: _Source) -> DataFrame:
    return risk.training_set(s.warehouse.delivery_features, s.warehouse.fact_orders)


def _scores(s: _Source) -> DataFrame:
    model = risk.train(_training(s))
    scored = risk.score(model, s.warehouse.delivery_features)
    return _rounded(scored.select("order_id", "late_probability", "late_prediction", "risk_label"), ["late_probability"], 4)


def _coefficients(indicators: bool) -> Callable[[_Source], DataFrame]:
    def fitted(s: _Source) -> DataFrame:
        return _rounded(risk.coefficients(s.spark, risk.train(_training(s), indicators)), ["coefficient"], 4)

    return fitted


def _evaluation(s: _Source) -> DataFrame:
    earlier, later = risk.split_by_time(_training(s))
    scored = risk.score(risk.train(earlier, stored=True), later)
    return _rounded(risk.evaluate(scored, stored=True), ["roc_auc", "pr_auc", "brier_score"])


PROFILES: dict[str, Callable[[_Source], DataFrame]] = {
    "profile_overview": lambda s: profile.overview(s.all_raw()),
    "profile_columns": lambda s: profile.all_columns(s.all_raw()),
    "profile_missing": lambda s: profile.missing_values(s.all_raw()),
    "profile_duplicates": lambda s: profile.duplicate_summary(s.all_raw()),
    "key_cardinality": _cardinality,
    "order_status_distribution": lambda s: profile.value_distribution(s.raw("orders"), "order_status"),
    "late_flag_distribution": lambda s: profile.value_distribution(_exploratory(s), "is_late"),
    "delay_days": lambda s: _exploratory(s).select("order_id", "delivery_delay_days", "is_late"),
    "delay_describe": lambda s: _rounded(
        profile.describe(_exploratory(s), ["delivery_delay_days"]), ["mean", "std"]
    ),
    "timeline_describe": lambda s: _rounded(
        profile.describe(
            s.raw("orders"),
            [
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ],
        ),
        ["mean", "std"],
        places=2,  # seconds since the epoch have nine digits before the point
    ),
    "seller_ranking_full_history": lambda s: profile.seller_ranking(s.raw("order_items"), s.raw("orders")),
    "seller_history_preview": lambda s: profile.preview(
        s.warehouse.seller_performance, ["seller_id", "order_purchase_timestamp", "order_id"]
    ),
    "order_status_counts": lambda s: profile.value_counts(s.warehouse.silver("orders"), "order_status"),
    "order_late_counts": lambda s: profile.value_counts(s.warehouse.silver("orders"), "is_late"),
    "payment_type_counts": lambda s: profile.value_counts(s.warehouse.silver("order_payments"), "payment_type"),
    "review_score_counts": lambda s: profile.value_counts(s.warehouse.silver("order_reviews"), "review_score"),
    "item_value_summary": lambda s: _rounded(
        profile.numeric_summary(s.warehouse.silver("order_items"), ["price", "freight_value"]), ["avg_value"], places=4
    ),
}

QUALITY: dict[str, Query] = {
    "quality_customers": _silver_check("customers"),
    "quality_sellers": _silver_check("sellers"),
    "quality_products": _silver_check("products"),
    "quality_orders": _silver_check("orders"),
    "quality_order_items": _silver_check("order_items"),
    "quality_payments": _silver_check("order_payments"),
    "quality_reviews": _silver_check("order_reviews"),
    "quality_geolocation": _silver_check("geolocation"),
    "quality_category_translation": _silver_check("product_category_name_translation"),
    "quality_gold_fact_orders": _gold_check("fact_orders"),
    "quality_gold_fact_order_items": _gold_check("fact_order_items"),
    "quality_gold_seller_performance": _gold_check("seller_performance"),
    "quality_gold_delivery_features": _gold_check("delivery_features"),
    "feature_grain": _on(lambda s: quality.one_row_per_order(s.warehouse.delivery_features, "delivery_features")),
    "referential_integrity": _on(_integrity),
    "chronology_rules": _on(lambda s: quality.chronology_rules(s.raw("orders"))),
}

MODEL: dict[str, Callable[[_Source], DataFrame]] = {
    "training_set": _training,
    "training_summary": lambda s: risk.training_summary(
        risk.training_candidates(s.warehouse.delivery_features, s.warehouse.fact_orders)
    ),
    "imputed_features": lambda s: risk.imputed_features(_training(s)),
    "risk_scores": _scores,
    "risk_coefficients": _coefficients(False),
    "risk_coefficients_with_indicators": _coefficients(True),
    "risk_evaluation": _evaluation,
}

QUERIES: dict[str, Query] = (
    {name: _cleaned(table) for name, table in _CLEAN.items()}
    | {"clean_orders_from_text": _on(_orders_from_text)}
    | {table: _gold(table) for table in GOLD_TABLES}
    | {name: _kpi(query) for queries in DOMAINS.values() for name, query in queries.items()}
    | QUALITY
    | {name: _on(build) for name, build in PROFILES.items()}
    | {name: _on(build) for name, build in MODEL.items()}
)
