"""Seller history: what was known about a seller's earlier orders when each order was placed.

One row per (order, seller). "Earlier" means earlier in (purchase time, order id); an earlier order
that is still in transit counts as an order but has no outcome yet.

A plain window over ``seller_id`` sends a seller's whole history to one task, which fails when one
seller holds a large part of all rows. So every seller's history is cut along its own order, (purchase
time, order id), into super-blocks and these into blocks. Running sums inside a block, over the blocks of a
super-block and over the super-blocks of a seller add up to the history. There is a block for
``LEAST_BLOCK_ROWS`` orders; beyond ``EVEN_BLOCKS`` blocks both their number and their size grow with the square
root of the orders. A seller with ``b`` blocks has about the root of ``b`` super-blocks with as many blocks each,
so what is looked up for a row, and what a window over totals gathers, stays that small.

Where to cut comes from one sample of the orders, taken by hash where the tables are scanned: it also tells about
how many orders a seller has, so the orders aren't counted first. Blocks are even whatever the times and ids look like.

There is one plan for all sizes. Most sellers are one block: they have no totals of earlier ones, and totals are only
made of the orders of sellers that are cut. Cuts, at most one for ``LEAST_BLOCK_ROWS`` orders, are broadcast, so pairs
are only dealt by order, for the join, and by block, for the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST_BLOCK_ROWS = 50_000
EVEN_BLOCKS = 256
# Sampled orders for a block: sixteen vary a block's size by a quarter, sixty-four by an eighth.
_SAMPLED = 16
_MOST_SAMPLED = 64

# Totals that a history is made of: orders, known outcomes, late ones, known delays, summed delay.
_MEASURES = ["n_orders", "n_outcomes", "n_late", "n_delays", "sum_delay"]
# What they are sums of. Pairs travel with these two columns; sums are taken where they arrive.
_OUTCOME = ["is_late", "delivery_delay_days"]
# The seller as a key that is never NULL: the same key serves windows and joins.
_SELLER = ["_seller", "_unnamed"]
_BLOCK = [*_SELLER, "_super", "_block"]
_TIME = "order_purchase_timestamp"


def order_sellers(items: DataFrame) -> DataFrame:
    """Distinct (order, seller) pairs; an item without an order id belongs to no order."""
    return items.filter(F.col("order_id").isNotNull()).select("order_id", "seller_id").distinct()


def _with_outcome(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """Adds purchase time and outcome of the order; pairs of unknown orders are left out."""
    return pairs.join(orders.select("order_id", _TIME, *_OUTCOME), "order_id", "inner")


def _totals() -> dict[str, Column]:
    """The measures as sums over orders; NULL for a sum of none."""
    return {
        "n_orders": F.count(F.lit(1)),
        "n_outcomes": F.count("is_late"),
        "n_late": F.sum("is_late"),
        "n_delays": F.count("delivery_delay_days"),
        "sum_delay": F.sum("delivery_delay_days"),
    }


def _with_seller_key(pairs: DataFrame) -> DataFrame:
    no_seller = F.lit(0).cast(pairs.schema["seller_id"].dataType)
    return pairs.withColumns(
        {"_seller": F.coalesce(F.col("seller_id"), no_seller), "_unnamed": F.col("seller_id").isNull()}
    )


def _place() -> Column:
    """Place in a seller's history; an unknown purchase time comes first."""
    return F.struct(F.col(_TIME).alias("time"), F.col("order_id").alias("id"))


def _nth(places: str, parts: str) -> Column:
    """The places that cut a sorted array of places into so many equal parts."""
    at = F.sequence(F.lit(1), F.col(parts) - 1)
    found = F.transform(at, lambda i: F.get(places, F.floor(i * F.size(places) / F.col(parts)).cast("int")))
    return F.when(F.col(parts) > 1, F.array_distinct(found))


def _cuts_up_to(place: Column, cuts: str) -> Column:
    """How many of the cuts are at or before a place; 0 without cuts."""
    return F.when(F.col(cuts).isNull(), F.lit(0)).otherwise(F.size(F.filter(cuts, lambda cut: cut <= place)))


def _cuts(sold: DataFrame, orders: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Per large seller the places after which a super-block begins; per super-block those of its blocks."""
    rate = min(1.0, _SAMPLED / block_rows)
    chance = F.pmod(F.xxhash64("order_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # Both sides are filtered, so that neither shuffles what isn't in the sample.
    timed = orders.select("order_id", _TIME).filter(chance < rate)
    sampled = sold.filter(chance < rate).withColumn("_chance", chance)
    placed = sampled.join(timed, "order_id").select(*_SELLER, "_chance", _place().alias("_place"))
    sizes = placed.groupBy(*_SELLER).agg((F.count(F.lit(1)) / rate).alias("_orders"))
    even = F.ceil(F.col("_orders") / block_rows)
    many = F.ceil(EVEN_BLOCKS * F.sqrt(F.col("_orders") / (EVEN_BLOCKS * block_rows)))
    sizes = sizes.withColumn("_blocks", F.least(even, many).cast("int")).filter("_blocks > 1")
    sizes = sizes.withColumn("_supers", F.ceil(F.sqrt("_blocks")).cast("int"))
    sizes = sizes.withColumn("_inside", F.ceil(F.col("_blocks") / F.col("_supers")).cast("int"))
    marked = placed.join(sizes, _SELLER)

    def part_of(blocks: str) -> Column:
        return F.col("_chance") < F.col(blocks) * F.lit(float(_MOST_SAMPLED)) / F.col("_orders")

    supers = marked.filter(part_of("_supers")).groupBy(*_SELLER)
    supers = supers.agg(F.sort_array(F.collect_list("_place")).alias("_places"), F.max("_supers").alias("_supers"))
    supers = supers.select(*_SELLER, _nth("_places", "_supers").alias("_super_cuts"))
    inside = marked.filter(part_of("_blocks")).join(supers, _SELLER)
    inside = inside.withColumn("_super", _cuts_up_to(F.col("_place"), "_super_cuts")).groupBy(*_SELLER, "_super")
    blocks = inside.agg(F.sort_array(F.collect_list("_place")).alias("_places"), F.max("_inside").alias("_inside"))
    return supers, blocks.select(*_SELLER, "_super", _nth("_places", "_inside").alias("_cuts"))


def _dealt(pairs: DataFrame, supers: DataFrame, blocks: DataFrame) -> DataFrame:
    """Adds ``_super`` and ``_block``, 0 for sellers without cuts."""
    pairs = pairs.join(F.broadcast(supers), _SELLER, "left")
    pairs = pairs.withColumn("_super", _cuts_up_to(_place(), "_super_cuts")).drop("_super_cuts")
    pairs = pairs.join(F.broadcast(blocks), [*_SELLER, "_super"], "left")
    return pairs.withColumn("_block", _cuts_up_to(_place(), "_cuts")).drop("_cuts")


def _in_blocks(sold: DataFrame, orders: DataFrame, block_rows: int) -> DataFrame:
    """Pairs of known orders with their outcome, ``_super`` and ``_block``."""
    return _dealt(_with_outcome(sold, orders), *_cuts(sold, orders, block_rows))


def _sums_before(window, prefix: str) -> list[Column]:
    return [F.coalesce(F.sum(m).over(window), F.lit(0)).alias(f"{prefix}{m}") for m in _MEASURES]


def _earlier(partition: list[str], order: list[str]):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def seller_performance(items: DataFrame, orders: DataFrame, block_rows: int = LEAST_BLOCK_ROWS) -> DataFrame:
    # A seller id is its key, so pairs travel without it.
    sold = _with_seller_key(order_sellers(items)).drop("seller_id")
    supers, blocks = _cuts(sold, orders, block_rows)
    pairs = _dealt(_with_outcome(sold, orders), supers, blocks)
    in_block = _earlier(_BLOCK, [_TIME, "order_id"])
    inside = pairs.select(
        "order_id", _TIME, *_BLOCK, *[F.coalesce(t.over(in_block), F.lit(0)).alias(m) for m, t in _totals().items()]
    )
    of_cut = sold.join(F.broadcast(supers.select(*_SELLER)), _SELLER, "left_semi")
    of_cut = _dealt(_with_outcome(of_cut, orders), supers, blocks)
    totals = of_cut.groupBy(*_BLOCK).agg(*[t.alias(m) for m, t in _totals().items()])
    in_super = totals.select(*_BLOCK, *_sums_before(_earlier([*_SELLER, "_super"], ["_block"]), "before_"))
    super_totals = totals.groupBy(*_SELLER, "_super").agg(*[F.sum(m).alias(m) for m in _MEASURES])
    over = super_totals.select(*_SELLER, "_super", *_sums_before(_earlier(_SELLER, ["_super"]), "over_"))
    earlier = in_super.join(over, [*_SELLER, "_super"]).select(
        *_BLOCK, *[(F.col(f"before_{m}") + F.col(f"over_{m}")).alias(f"before_{m}") for m in _MEASURES]
    )
    joined = inside.join(earlier, _BLOCK, "left")

    def total(measure: str) -> Column:
        return F.col(measure) + F.coalesce(F.col(f"before_{measure}"), F.lit(0))

    orders_before = total("n_orders")
    late_before = F.when(total("n_outcomes") > 0, total("n_late"))
    return joined.select(
        "order_id",
        F.when(~F.col("_unnamed"), F.col("_seller")).alias("seller_id"),
        _TIME,
        orders_before.alias("seller_order_count"),
        late_before.alias("seller_late_order_count"),
        F.round(F.try_divide(late_before, orders_before), 4).alias("seller_late_rate"),
        F.round(F.try_divide(total("sum_delay"), total("n_delays")), 2).alias("seller_avg_delivery_delay_days"),
    )
