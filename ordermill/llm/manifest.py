"""Merkle manifest of a dataset, with proofs made by octopus multiproofs.

Every row is a leaf. The leaves of a source, in ascending order, are hashed in runs of three, level by level,
until one node is left, the subroot; the subroots, in order of source, are hashed likewise to the root.

A leaf partition is a stretch of the global order made of whole blocks of ``BLOCK`` leaves. It works out which
nodes its leaves' proofs need and its own leaves can't give (at most two on either side of a level), fetches
this union once by a join with the stored nodes, derives the nodes that its proofs share, and expands
each leaf's proof from the proof of the leaf's parent. Nodes below a block's root are never stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored

#: Children of a node, levels of a block, leaves of a block, and leaves of a leaf partition (and a block more at most).
FAN = 3
BLOCK_LEVELS = 7
BLOCK = FAN**BLOCK_LEVELS
PARTITION_LEAVES = 3 * BLOCK
#: The tree over the subroots; sources are numbered from 0.
TOP = -1

_NODES = "tree long, n long, level int, index long, digest string"


def sealed(parts: Iterable[str]) -> str:
    """The digest of digests in hexadecimal, put one after the other."""
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def levels_of(n: int) -> list[int]:
    """How many nodes a tree over ``n`` leaves has on each level, from the leaves to the root."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FAN))
    return sizes


def parents(nodes: list[str]) -> list[str]:
    return [sealed(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]


def missing(low: int, high: int, n: int) -> Iterator[tuple[int, int]]:
    """(level, index) of the nodes that proofs of leaves ``low`` to ``high - 1`` of ``n`` need besides their own."""
    for level, size in enumerate(levels_of(n)[:-1]):
        first, last = low // FAN * FAN, min(-(-high // FAN) * FAN, size)
        yield from ((level, i) for i in chain(range(first, low), range(high, last)))
        low, high = low // FAN, -(-high // FAN)


class Stretch:
    """Consecutive leaves of one tree with all nodes that their proofs go through."""

    def __init__(self, low: int, leaves: list[str], n: int, fetched: dict[tuple[int, int], str]):
        self.low, self.sizes = low, levels_of(n)
        #: Per level the first node's index and the nodes, filled up to whole runs.
        self.levels: list[tuple[int, list[str]]] = []
        own = leaves
        for level, size in enumerate(self.sizes[:-1]):
            first, high = low // FAN * FAN, low + len(own)
            before = [fetched[level, i] for i in range(first, low)]
            after = [fetched[level, i] for i in range(high, min(-(-high // FAN) * FAN, size))]
            run = before + own + after
            self.levels.append((first, run))
            low, own = low // FAN, parents(run)
        self.top = own[0]

    def _siblings(self, level: int, index: int) -> tuple[str, str]:
        first, nodes = self.levels[level]
        at, start = index - first, index // FAN * FAN - first
        return "".join(nodes[start:at]), "".join(nodes[at + 1 : start + FAN])

    def proofs(self, leaves: int) -> list[str]:
        """Siblings from leaf to top of each of the first ``leaves`` leaves; a parent's are worked out once."""
        ranges = [(self.low, self.low + leaves)]
        for _ in self.levels:
            ranges.append((ranges[-1][0] // FAN, -(-ranges[-1][1] // FAN)))
        above, above_first = [""], ranges[-1][0]
        for level in range(len(self.levels) - 1, -1, -1):
            low, high = ranges[level]
            above = ["".join(self._siblings(level, i)) + above[i // FAN - above_first] for i in range(low, high)]
            above_first = low
        return above

    def folded(self, index: int, digest: str) -> str:
        """The top that follows from ``digest`` in place of leaf ``index``."""
        for level in range(len(self.levels)):
            before, after = self._siblings(level, index)
            digest, index = sealed((before, digest, after)), index // FAN
        return digest


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of the values in order: ``-`` for null, else length in UTF-8 bytes, a colon and the value."""

    def framed(column: Column) -> Column:
        value = column.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


def _ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``rank``, from 0 on by ``order``, which must tell all rows apart; sorted by ranges, stored once."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()))
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("part")
    total, starts = 0, []
    for row in counts.collect():  # one row a partition of Spark's
        starts.append((row["part"], total))
        total += row["rows"]
    starts = df.sparkSession.createDataFrame(starts, "part long, start long")
    ranked = ordered.withColumn("part", part).join(F.broadcast(starts), "part")
    return ranked.withColumn("rank", F.col("start") + place).drop("part", "start", "at")


def _lifted(nodes: DataFrame, level: int, lowest: int) -> DataFrame:
    """Nodes up to ``BLOCK_LEVELS`` above those of ``level``, from ``lowest`` on; also that level's if it is its tree's top.

    ``nodes`` holds ``tree``, ``n`` (its leaves), ``index`` and ``digest``. A task holds one block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*(b.column(i).to_pylist() for i in range(5)), strict=True) for b in batches)
        found: list[tuple] = []
        for (tree, block), members in groupby(rows, lambda r: (r[0], r[1])):
            members = list(members)
            n, digests = members[0][2], [r[4] for r in members]
            sizes, at, index = levels_of(n), level, members[0][3]
            while True:
                if at >= lowest or at == len(sizes) - 1:
                    found += [(tree, n, at, index + i, d) for i, d in enumerate(digests)]
                if at == len(sizes) - 1 or at == level + BLOCK_LEVELS:
                    break
                digests, at, index = parents(digests), at + 1, index // FAN
            if len(found) > 50_000:
                yield _batch(found)
                found = []
        if found:
            yield _batch(found)

    def _batch(found: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        values = [pa.array(v, t) for v, t in zip(zip(*found, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(values, names=["tree", "n", "level", "index", "digest"])

    blocks = nodes.select("tree", F.floor(F.col("index") / BLOCK).alias("block"), "n", "index", "digest")
    return blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "index").mapInArrow(run, _NODES)


def _all_nodes(leaves: DataFrame, most: int, lowest: int) -> DataFrame:
    """Nodes from level ``lowest`` on of trees of at most ``most`` leaves, and every tree's top."""
    found, level = [stored(_lifted(leaves, 0, lowest))], BLOCK_LEVELS
    while most > FAN**level:
        below = found[-1].filter((F.col("level") == level) & (F.col("n") > FAN**level))
        found.append(stored(_lifted(below, level, level + 1)))
        level += BLOCK_LEVELS
    return reduce(DataFrame.unionByName, found)


def _requests(placed: DataFrame, sources: int) -> DataFrame:
    """What each leaf partition has to fetch: ``part``, ``tree``, ``level``, ``index``, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = []
            for part, stretches in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                trees = [s["tree"] for s in stretches]
                for s in stretches:
                    wanted += [(part, s["tree"], level, i) for level, i in missing(s["low"], s["high"], s["n"])]
                wanted += [(part, TOP, level, i) for level, i in missing(min(trees), max(trees) + 1, sources)]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            columns = zip(*wanted, strict=True) if wanted else [()] * 4
            values = [pa.array(v, t) for v, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(values, names=["part", "tree", "level", "index"])

    stretches = placed.groupBy("part", "tree", "n").agg(
        F.min("index").alias("low"), (F.max("index") + 1).alias("high")
    )
    listed = stretches.groupBy("part").agg(F.collect_list(F.struct("tree", "n", "low", "high")).alias("stretches"))
    return listed.mapInArrow(run, "part long, tree long, level int, index long")


def _expanded(placed: DataFrame, fetched: DataFrame, sources: int) -> DataFrame:
    """Proofs of all leaves, each leaf partition with what it fetched."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        known: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, index, digest in zip(
            *(nodes.column(c).to_pylist() for c in ("tree", "level", "index", "digest")), strict=True
        ):
            known.setdefault(tree, {})[level, index] = digest
        leaves = leaves.sort_by([("tree", "ascending"), ("index", "ascending")])
        rows = zip(*(leaves.column(c).to_pylist() for c in ("tree", "index", "n", "digest", "claimed")), strict=True)
        members = {tree: list(m) for tree, m in groupby(rows, lambda r: r[0])}
        own = {t: Stretch(m[0][1], [r[3] for r in m], m[0][2], known.get(t, {})) for t, m in members.items()}
        trees = sorted(own)
        top = Stretch(trees[0], [own[t].top for t in trees], sources, known.get(TOP, {}))
        tops = dict(zip(trees, top.proofs(len(trees)), strict=True))
        found = []
        for tree, stretch in own.items():
            for proof, (_, index, _, digest, claimed) in zip(stretch.proofs(len(members[tree])), members[tree], strict=True):
                folded = top.folded(tree, stretch.folded(index, claimed))
                found.append((digest, stretch.top, top.top, sealed((proof, tops[tree])), folded, folded == top.top))
        columns = [pa.array(v) for v in zip(*found, strict=True)]
        return pa.Table.from_arrays([leaves.column("doc_id"), *columns], names=names)

    fields = f"doc_id {placed.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} string" for c in names[1:-1])
    groups = placed.groupBy("part").cogroup(fetched.groupBy("part"))
    return groups.applyInArrow(expand, fields + ", verified boolean")


def manifest(docs: DataFrame, leaf: Column, claimed: Column) -> DataFrame:
    """Digests, proofs and their check for all rows of ``docs``, which has ``doc_id`` and ``source``.

    ``leaf`` is a row's digest; ``claimed`` is the digest that is checked against the root by the row's proof.
    ``subroot``, ``root`` and ``proof_sha256`` (digest of the siblings from the leaf up, left to right) belong to
    ``leaf``; ``folded_root`` follows from ``claimed`` and the same siblings, ``verified`` tells whether it is the root.

    Sources are in order of their UTF-8 bytes, null first; rows in order of ``doc_id``, null first, then of the
    leaf. Rows that are equal in all of this are leaves of their own, side by side. Lengths of values don't
    matter: only digests are shuffled. An empty table gives no rows; further columns are ignored. No source,
    however large, is more than one leaf partition's work for a task.
    """
    digests = docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), leaf.alias("digest"), claimed.alias("claimed")
    )
    digests = stored(digests.withColumn("tie", F.monotonically_increasing_id()))
    ranked = _ranked(digests, ["source", "doc_id", "digest", "tie"])
    counted = ranked.groupBy("source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = stored(_ranked(counted.withColumnRenamed("source", "of"), ["first"]).withColumnRenamed("rank", "tree"))
    summed = sources.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("most")).first()
    in_source = ranked.join(sources, F.col("source").eqNullSafe(F.col("of")))
    in_source = in_source.withColumn("index", F.col("rank") - F.col("first"))
    part = F.floor((F.col("rank") - F.pmod("index", F.lit(BLOCK))) / PARTITION_LEAVES)
    placed = stored(in_source.select(part.alias("part"), "tree", "n", "index", "doc_id", "digest", "claimed"))
    nodes = _all_nodes(placed.select("tree", "n", "index", "digest"), summed["most"] or 0, BLOCK_LEVELS)
    subroots = nodes.filter("index = 0").groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
    trees = summed["trees"]
    over = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"), F.col("tree").alias("index"), "digest"
    )
    every = nodes.unionByName(_all_nodes(over, trees, 0)).select("tree", "level", "index", "digest")
    fetched = _requests(placed, trees).join(every, ["tree", "level", "index"])
    return _expanded(placed, fetched, trees)


def oracle_sql() -> str:
    """DuckDB SQL for the query over ``documents``: nodes and folds level by level; CRC-32 by its bits."""

    def leaf(text: str) -> str:
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        framed = [f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields]
        return f"sha256({' || '.join(framed)})"

    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)"
    byte = f"list_reduce(range(8), lambda c, bit: {step}, xor(crc, d))"
    crc = f"xor(list_reduce({digits}, lambda crc, d: {byte}, 4294967295::BIGINT), 4294967295)"
    run = "PARTITION BY tree, level, i // 3 ORDER BY i ROWS BETWEEN"

    def tree(name: str, start: str) -> str:
        return f"""
{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, i // 3, sha256(string_agg(d, '' ORDER BY i)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, level, i // 3, n),
{name}_runs AS (
  SELECT tree, level, i,
    coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1)"""

    def fold(name: str, start: str, runs: str) -> str:
        return f"""
{name} AS (
  {start}
  UNION ALL
  SELECT f.k, f.tree, f.level + 1, f.i // 3, sha256(s.l || f.v || s.r), f.proof || s.l || s.r
  FROM {name} f JOIN {runs} s ON s.tree IS NOT DISTINCT FROM f.tree AND s.level = f.level AND s.i = f.i),
{name}_end AS (SELECT k, max_by(v, level) AS v, max_by(proof, level) AS proof FROM {name} GROUP BY k)"""

    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source AS tree, {leaf('text')} AS leaf,
    CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS claimed,
    row_number() OVER () AS k,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n
  FROM documents),
{tree('nodes', "SELECT tree, 0 AS level, i, leaf AS d, n FROM leaves")},
subroots AS (
  SELECT tree AS source, d, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
{tree('tops', "SELECT 0 AS tree, 0 AS level, i, d, n FROM subroots")},
{fold('inner_fold', "SELECT k, tree, 0 AS level, i, claimed AS v, '' AS proof FROM leaves", 'nodes_runs')},
{fold('outer_fold', '''SELECT e.k, 0 AS tree, 0 AS level, s.i, e.v, e.proof FROM inner_fold_end e
  JOIN leaves l ON l.k = e.k JOIN subroots s ON s.source IS NOT DISTINCT FROM l.tree''', 'tops_runs')},
root AS (SELECT d FROM tops WHERE n = 1)
SELECT l.doc_id, l.leaf, s.d AS subroot, root.d AS root, sha256(o.proof) AS proof_sha256, o.v AS folded_root,
  o.v = root.d AS verified
FROM leaves l JOIN outer_fold_end o ON o.k = l.k JOIN subroots s ON s.source IS NOT DISTINCT FROM l.tree, root
"""
