"""Review KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.columns import month_of, report_round, share
from ordermill.plans.kpis.delivery import days_late


def _reviewed_orders(tables) -> DataFrame:
    outcome = tables.fact_orders.select("order_id", "delivery_delay_days", "is_late")
    return tables.fact_reviews.select("order_id", "review_score").join(outcome, "order_id")


def overall_review_kpis(tables) -> DataFrame:
    return tables.fact_reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        report_round(F.avg("review_score")).alias("average_review_score"),
    )


def review_score_distribution(tables) -> DataFrame:
    counted = tables.fact_reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("reviews"))
    total = counted.agg(F.sum("reviews")).scalar()
    return counted.select(
        "review_score",
        "reviews",
        report_round(share(F.col("reviews") * 100, total)).alias("percentage"),
    ).orderBy(F.asc_nulls_last("review_score"))


def review_score_vs_delivery_performance(tables) -> DataFrame:
    return (
        _reviewed_orders(tables)
        .groupBy("review_score")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            report_round(F.avg(days_late())).alias("average_delivery_delay"),
            report_round(F.avg("is_late") * 100).alias("late_delivery_rate"),
        )
        .orderBy(F.asc_nulls_last("review_score"))
    )


def reviews_by_delivery_status(tables) -> DataFrame:
    """An order whose outcome is unknown counts as on time."""
    return (
        _reviewed_orders(tables)
        .groupBy(F.when(F.col("is_late") == 1, "Late").otherwise("On Time").alias("delivery_status"))
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            report_round(F.avg("review_score")).alias("average_review_score"),
        )
        .orderBy("delivery_status")
    )


def review_score_by_month(tables) -> DataFrame:
    return (
        tables.fact_reviews.groupBy(month_of("review_creation_date").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            report_round(F.avg("review_score")).alias("average_review_score"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


QUERIES = {
    "overall_review_kpis": overall_review_kpis,
    "review_score_distribution": review_score_distribution,
    "review_score_vs_delivery_performance": review_score_vs_delivery_performance,
    "reviews_by_delivery_status": reviews_by_delivery_status,
    "review_score_by_month": review_score_by_month,
}
