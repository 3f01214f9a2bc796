"""Sharding by a k-d tree over document metadata.

The tree starts with one node for all shards. A node of several shards is cut at the weighted median
(by bytes, in proportion to the shards on either side) along the dimension in which its documents spread
widest, until every leaf is one shard of the target size. All dimensions are computed from the text, and
the order along one is settled by the text's hash, so equal texts stay together. A group of copies in
which a median falls goes to one side as a whole, and the median is sought again among the other rows;
only a group too heavy for either side is cut itself, by the hash of the ids.

All nodes of a level are cut at once. A median is found by counting bytes in equal ranges of the keys
and narrowing to the range it lies in. The driver sees a bounded number of sums a round, never rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import stored

OVERHEAD = 8
#: Ranges into which a round cuts the keys of a node.
RANGES = 1024
#: A cut is good enough when it is off by this part of a shard.
TOLERANCE = 0.0005
#: A group of copies is set apart if leaving it at its place would put a cut off by this part of a shard.
GROUP_SHIFT = 0.01
#: Once so many groups are set apart in a node, only those that put a cut off by a larger part are.
FEW_APART = 4
LATER_SHIFT = 0.04
#: A group may make a side heavier than its share by this part of a shard.
GROUP_EXCESS = 0.04
_HASH_BITS = 31


def metadata(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``order`` (hash of the id) and a key for each dimension.

    A key holds the dimension's value, up to 2^32, and below it the text's hash.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    values = {
        "key_size": size,
        "key_beyond_ascii": size - F.char_length(text),
        "key_lines": size - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))),
    }
    hashed = F.xxhash64(text).bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
    return docs.select(
        "doc_id",
        F.when(F.isnull("text"), F.lit(0)).otherwise(size).cast("long").alias("bytes"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)).bitwiseAND(F.lit((1 << _HASH_BITS) - 1)).alias("order"),
        *[(F.shiftleft(v.cast("long"), _HASH_BITS) + hashed).alias(k) for k, v in values.items()],
    ).withColumn("size", F.col("bytes") + OVERHEAD).drop("bytes")


KEYS = ["key_size", "key_beyond_ascii", "key_lines"]


@dataclass
class _Node:
    """Shards ``first`` to ``first + shards - 1``; once cut, rows before the cut go to ``low``."""

    first: int
    shards: int
    weight: int = 0
    key: str = ""
    cut: int = 0  # keys up to here go low
    order_cut: int | None = None  # of the rows with exactly this key, ids' hashes up to here do
    apart: dict[int, bool] = field(default_factory=dict)  # keys of groups set apart: whether they go low
    low: _Node | None = None
    high: _Node | None = None
    bounds: tuple[int, int] = field(default=(0, 0))

    def column(self, leaf) -> Column:
        """What ``leaf(node)`` gives for the leaf that a row falls into."""
        if self.low is None:
            return leaf(self)
        goes_low = F.col(self.key) <= F.lit(self.cut)
        if self.order_cut is not None:
            goes_low = (F.col(self.key) < F.lit(self.cut)) | (
                (F.col(self.key) == F.lit(self.cut)) & (F.col("order") <= F.lit(self.order_cut))
            )
        for key, low in self.apart.items():
            goes_low = F.when(F.col(self.key) == F.lit(key), F.lit(low)).otherwise(goes_low)
        return F.when(goes_low, self.low.column(leaf)).otherwise(self.high.column(leaf))

    def leaves(self) -> list[_Node]:
        return [self] if self.low is None else self.low.leaves() + self.high.leaves()


@dataclass
class _Search:
    """A median being narrowed: the rows with ``low <= key <= high``, ``below`` bytes lie before them.

    ``target`` bytes are to lie before the cut, of the ``weight`` bytes of rows that aren't set apart.
    """

    node: _Node
    weight: int
    target: float
    extent: tuple[int, int]
    low: int
    high: int
    below: int
    key: str
    only_key: int | None = None  # searching ids' hashes among the rows with this key


def _cases(searches: list[_Search], node: Column, value) -> Column:
    """``value(search)`` for the search of the row's node; null for rows of other nodes."""
    out = F.lit(None)
    for i, s in enumerate(searches):
        out = F.when(node == F.lit(s.node.first), value(i, s)).otherwise(out)
    return out


def _range_sums(rows: DataFrame, node: Column, searches: list[_Search]) -> dict[int, list]:
    """Per search its non-empty ranges in order: (bytes, smallest key, largest key)."""

    def entry(i: int, s: _Search) -> Column:
        key = F.col(s.key)
        width = (s.high - s.low) // RANGES + 1
        inside = key.between(F.lit(s.low), F.lit(s.high))
        if s.only_key is not None:
            inside = inside & (F.col(s.node.key) == F.lit(s.only_key))
        elif s.node.apart:
            inside = inside & ~key.isin(list(s.node.apart))
        place = F.floor((key - F.lit(s.low)) / F.lit(width)) if width > 1 else key - F.lit(s.low)
        return F.when(inside, F.struct(F.lit(i).alias("search"), place.cast("long").alias("place"), key.alias("key")))

    sums = (
        rows.select("size", _cases(searches, node, entry).alias("e"))
        .filter("e IS NOT NULL")
        .groupBy("e.search", "e.place")
        .agg(F.sum("size").alias("bytes"), F.min("e.key").alias("low"), F.max("e.key").alias("high"))
        .collect()
    )
    found: dict[int, list] = {i: [] for i in range(len(searches))}
    for r in sorted(sums, key=lambda r: (r["search"], r["low"])):
        found[r["search"]].append((r["bytes"], r["low"], r["high"]))
    return found


def _narrowed(s: _Search, ranges: list, shard: float) -> _Search | None:
    """The search in the range that holds the median, or None once the node's cut is set."""
    below = s.below
    for nth, (bytes_, low, high) in enumerate(ranges):
        if below + bytes_ < s.target and nth < len(ranges) - 1:
            below += bytes_
            continue
        before = ranges[nth - 1][2] if nth else s.low - 1
        # The cut may go before or behind the range.
        off, cut = min((abs(below - s.target), before), (abs(below + bytes_ - s.target), high))
        if low != high and off > TOLERANCE * shard:
            return replace(s, low=low, high=high, below=below)
        if s.only_key is not None:
            s.node.order_cut = cut
        elif low != high or off <= (GROUP_SHIFT if len(s.node.apart) < FEW_APART else LATER_SHIFT) * shard:
            s.node.cut = cut
        else:
            return _set_apart(s, low, bytes_, below, shard)
        return None
    s.node.cut = s.extent[0] - 1
    return None


def _set_apart(s: _Search, key: int, bytes_: int, below: int, shard: float) -> _Search:
    """The search that follows once the group with this key has a side, or is to be cut itself."""
    excess = GROUP_EXCESS * shard
    goes_low = bytes_ <= s.target + excess
    if not goes_low and bytes_ > s.weight - s.target + excess:
        s.node.cut = key
        return replace(s, low=0, high=(1 << _HASH_BITS) - 1, below=below, key="order", only_key=key)
    s.node.apart[key] = goes_low
    low, high = s.extent
    target = max(0.0, s.target - bytes_) if goes_low else s.target
    return replace(s, weight=s.weight - bytes_, target=target, low=low, high=high, below=0)


def _cut_level(rows: DataFrame, root: _Node, nodes: list[_Node], shard: float) -> None:
    """Cuts all ``nodes`` and gives them their halves."""
    node = root.column(lambda n: F.lit(n.first))
    extents = {
        r["node"]: r
        for r in rows.groupBy(node.alias("node"))
        .agg(F.sum("size").alias("bytes"), *[f(k).alias(f"{n}_{k}") for k in KEYS for n, f in (("low", F.min), ("high", F.max))])
        .collect()
    }
    if root in nodes:
        root.bounds = tuple(extents[0][f"high_{k}"] - extents[0][f"low_{k}"] + 1 for k in KEYS) if extents else (1,) * len(KEYS)
    searches = []
    for n in nodes:
        low_shards = n.shards // 2
        e = extents.get(n.first)
        n.key, n.weight = KEYS[0], e["bytes"] if e else 0
        if e:
            spread = [(e[f"high_{k}"] - e[f"low_{k}"] + 1) / whole for k, whole in zip(KEYS, root.bounds, strict=True)]
            n.key = KEYS[spread.index(max(spread))]
            target = n.weight * low_shards / n.shards
            extent = (e[f"low_{n.key}"], e[f"high_{n.key}"])
            searches.append(_Search(n, n.weight, target, extent, *extent, 0, n.key))
    while searches:
        found = _range_sums(rows, node, searches)
        searches = [x for i, s in enumerate(searches) if (x := _narrowed(s, found[i], shard))]
    for n in nodes:
        n.low = _Node(n.first, n.shards // 2)
        n.high = _Node(n.first + n.shards // 2, n.shards - n.shards // 2)


def tree(rows: DataFrame, n_shards: int) -> _Node:
    """The k-d tree of ``metadata`` rows; about five rounds of sums for each of its levels."""
    root = _Node(0, n_shards)
    total = rows.agg(F.sum("size")).first()[0] or 0
    while nodes := [n for n in root.leaves() if n.shards > 1]:
        _cut_level(rows, root, nodes, total / n_shards)
    return root


def shard_documents(docs: DataFrame, n_shards: int, block_rows: int = 100_000) -> DataFrame:
    """Per row ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``bytes``: shards hold nearly equal sizes (UTF-8 bytes and 8 for each row), as far as rows
    and groups of equal texts allow; ``grown_shard`` is null. Slots count from 0 in each shard, in blocks by
    the hash of the id, within them by id and text, so that no shard has to meet in one task. A null text
    has no bytes; repeated rows get a slot each; an empty table gives no rows; other columns are ignored.
    """
    rows = stored(metadata(docs))
    root = tree(rows, n_shards)
    n_blocks = max(1, rows.count() // block_rows)
    block = F.floor(F.col("order") * n_blocks / F.lit(1 << _HASH_BITS)).cast("int")
    placed = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        "key_size",
        root.column(lambda n: F.lit(n.first)).alias("shard"),
        block.alias("block"),
    )
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "key_size")
    ranked = placed.withColumn("nth", F.row_number().over(within)).join(firsts, ["shard", "block"])
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
