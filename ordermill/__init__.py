"""Marketplace-order analytics on Spark: cleaning, star schema, quality gates, KPIs, delivery risk."""
