"""The report queries, by domain. Each takes the star-schema tables and returns one ordered result.

``tables`` is anything with the gold tables as attributes (see ``ordermill.plans.warehouse``).
Rows that tie in a ranking are ordered by their key, so a top-20 is the same on every run.
"""

from __future__ import annotations

from ordermill.plans.kpis import customers, delivery, products, reviews, sales, sellers

DOMAINS = {
    "customers": customers.QUERIES,
    "delivery": delivery.QUERIES,
    "products": products.QUERIES,
    "review": reviews.QUERIES,
    "sales": sales.QUERIES,
    "sellers": sellers.QUERIES,
}
