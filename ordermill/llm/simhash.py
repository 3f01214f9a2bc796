"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints that differ in at most two of 64 bits agree in two of four 16-bit blocks. So each distinct
fingerprint goes to six groups, one for every choice of two blocks, and near ones meet in one of them.
A group larger than ``most`` is cut again: of three parts of its remaining bits, one agrees. After three
cuts at most ten bits remain, so no group can be large.

Inside a group the fingerprints are sorted by Gray rank, where neighbours share many bits, and factored:
an upper node holds the bits its children share, a child only what it adds. A search adds up differences
on its way down and leaves a whole node as soon as they exceed the limit. A group returns a spanning
forest of its links, not all pairs; connected components join them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import alike
from ordermill.llm.common import map_texts, stored, whole_texts
from ordermill.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MOST_BITS = 2
FANOUT = 8
_BYTES_AT_A_TIME = 1 << 20


def _bit_counts(hashes: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for at in range(0, len(rows), 8192):
        total += np.unpackbits(rows[at : at + 8192], axis=1).sum(axis=0, dtype=np.int32)
    return total


def fingerprint(text: str) -> int:
    """Signed 64-bit SimHash of the three-word shingles of a text; zero if it has no word."""
    raw = text.encode("utf-8").lower()  # bytes: lower-cases A-Z only, splits at ASCII white space only
    total, n, held, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(raw):
        end = at + _BYTES_AT_A_TIME
        while end < len(raw) and not raw[end : end + 1].isspace():
            end += 1
        words = held + raw[at:end].split()
        at = end
        if len(words) < SHINGLE_WORDS:
            held = words
            continue
        joined, start, starts = b" ".join(words), 0, []
        for w in words:
            starts.append(start)
            start += len(w) + 1
        ends = [s - 1 for s in starts[SHINGLE_WORDS:]] + [len(joined)]
        digest = xxhash.xxh64_digest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=False)]
        total += _bit_counts(hashes)
        n += len(hashes)
        held = words[1 - SHINGLE_WORDS :]
    if not n:
        if not held:
            return 0
        total, n = _bit_counts([xxhash.xxh64_digest(b" ".join(held), SEED)]), 1
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id``, ``others``, ``fp`` (long) for every row. A null text counts as empty."""
    return map_texts(whole_texts(docs, *others), lambda: lambda texts: [(fingerprint(t),) for t in texts], "fp long")


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit code in the sequence of reflected Gray codes."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


class GrayIndex:
    """Index of codes that are sorted by Gray rank. ``levels[0]`` are the codes, the last is the root level."""

    def __init__(self, codes: np.ndarray):
        value, shared = codes, np.full(len(codes), 2**64 - 1, np.uint64)
        full = [(value, shared)]
        while len(value) > FANOUT:
            firsts = np.arange(0, len(value), FANOUT)
            ones = np.bitwise_and.reduceat(value, firsts)
            # Bits that all children fix, and fix to the same.
            fixed = np.bitwise_and.reduceat(shared, firsts)
            any_one = np.bitwise_or.reduceat(value, firsts)
            shared = fixed & ~(any_one ^ ones)
            value = ones & shared
            full.append((value, shared))
        self.levels = []
        for i, (value, shared) in enumerate(full):
            above = full[i + 1][1][np.arange(len(value)) // FANOUT] if i + 1 < len(full) else np.uint64(0)
            self.levels.append((value, shared & ~above))

    def near(self, first: int, last: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j), first <= i < last and j > i, whose codes differ in at most ``most`` bits."""
        codes = self.levels[0][0]
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        query = np.repeat(np.arange(first, last), n)
        node = np.tile(np.arange(n), last - first)
        apart = np.zeros(len(query), np.uint8)
        for level in range(top, -1, -1):
            value, own = self.levels[level]
            apart = apart + np.bitwise_count((codes[query] ^ value[node]) & own[node])
            keep = (apart <= most) & ((node + 1) * FANOUT**level > query + 1)
            query, node, apart = query[keep], node[keep], apart[keep]
            if level:
                below = len(self.levels[level - 1][0])
                child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query, apart = np.repeat(query, FANOUT), np.repeat(apart, FANOUT)
                inside = child < below
                query, node, apart = query[inside], child[inside], apart[inside]
        return query, node


def spanning_links(codes: np.ndarray, most: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all codes (sorted by Gray rank) which a chain of near ones connects."""
    index, root = GrayIndex(codes), np.arange(len(codes))
    for first in range(0, len(codes), 256):
        i, j = index.near(first, min(first + 256, len(codes)), most)
        while True:
            low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
            apart = low != high
            if not apart.any():
                break
            np.minimum.at(root, high[apart], low[apart])
            while (root != root[root]).any():
                root = root[root]
    member = np.flatnonzero(root != np.arange(len(codes)))
    return codes[member], codes[root[member]]


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of all groups; rows come sorted by ``key`` and Gray rank. Holds a batch and one group."""
    held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.uint64)]

    def links(key: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        length = np.diff(np.r_[first, len(key)])
        size = np.repeat(length, length)
        found = []
        # A group that fits a node needs no levels above it.
        for lag in range(1, FANOUT):
            near = (key[lag:] == key[:-lag]) & (size[lag:] <= FANOUT)
            near &= np.bitwise_count(code[lag:] ^ code[:-lag]) <= MOST_BITS
            found.append((code[:-lag][near], code[lag:][near]))
        for at, n in zip(first[length > FANOUT], length[length > FANOUT], strict=True):
            found.append(spanning_links(code[at : at + n]))
        u, v = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)]
        key, code = (np.concatenate(x) for x in zip(held, now, strict=True))
        cut = np.searchsorted(key, key[-1])
        held = [key[cut:], code[cut:]]
        if cut:
            yield links(key[:cut], code[:cut])
    if len(held[0]):
        yield links(*held)


def _parts(bits: list[int], n: int) -> list[int]:
    """``bits`` in ``n`` runs of nearly equal length, each as a mask."""
    cuts = [round(i * len(bits) / n) for i in range(n + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _grouped(codes: DataFrame, most: int) -> DataFrame:
    """``mask``, ``fp``, ``key``: near fingerprints share a key, and no key has more than ``most`` of them."""

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("key", F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))))

    blocks = _parts(list(range(64)), 4)
    masks = [a | b for a, b in combinations(blocks, 2)]
    rows = keyed(codes.select(F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"), "fp"))
    done = None
    while True:
        finer = {m: [m | p for p in _parts([b for b in range(64) if not m >> b & 1], MOST_BITS + 1)] for m in masks}
        large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("key")
        if not masks or bin(masks[0]).count("1") >= 54 or large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        rest = rows.join(large, "key", "left_anti").select("mask", "fp", "key")
        done = rest if done is None else done.unionByName(rest)
        choice = F.create_map(*[x for m, ms in finer.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in ms]))])
        rows = rows.join(large, "key", "left_semi").select(F.explode(choice[F.col("mask")]).alias("mask"), "fp")
        rows = stored(keyed(rows))
        masks = [m for ms in finer.values() for m in ms]


def fingerprint_components(codes: DataFrame, most: int = 4096) -> DataFrame:
    """``node``, ``root`` for distinct fingerprints ``fp`` that have a link; the others are alone."""
    rows = _grouped(codes, most).select("key", "fp", gray_rank(F.col("fp")).alias("rank"))
    dealt = rows.repartition("key").sortWithinPartitions("key", "rank").select("key", "fp")
    return components(dealt.mapInArrow(_group_links, "u long, v long"))


def _in_components(docs: DataFrame, others: list[str], most: int) -> DataFrame:
    """``doc_id``, ``others``, ``fp``, ``root`` (of the component), ``component_id`` for every row."""
    marked = stored(fingerprints(docs, *others))
    codes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = fingerprint_components(codes.select("fp"), most)
    rooted = codes.join(found, codes["fp"] == found["node"], "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_code = rooted.join(named, "root").select("fp", "root", "component_id")
    return marked.join(by_code, "fp").select("doc_id", *others, "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, most: int = 4096) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hexadecimal), ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links of at most two differing bits reach. A null text
    counts as empty; texts without a word have fingerprint zero and are linked like any other; a null
    ``doc_id`` is in its component but names it only if it has no other. Repeated rows stay; an empty table
    gives no rows; other columns are ignored. ``most`` is the size from which groups are cut again.
    """
    code = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return _in_components(docs, [], most).select("doc_id", code, "component_id")


def one_of_each(docs: DataFrame, most: int = 4096, alike_words: int | None = None) -> DataFrame:
    """The rows of ``docs`` with one of each component: smallest ``doc_id``, then by the text's hash.

    With ``alike_words``, texts are also linked if the Jaccard similarity of their shingles of so many words is
    0.8 or more, whatever their fingerprints. Rows that repeat with id and text are one document.
    """
    hashed = docs.withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = stored(_in_components(hashed, ["_hash"], most))
    if alike_words:
        roots = found.groupBy(F.col("_hash").alias("id")).agg(F.min("root").alias("root"))
        merged = components(alike.links(hashed.select(F.col("_hash").alias("id"), "text"), roots, alike_words))
        merged = merged.select("node", F.col("root").alias("into"))
        found = found.join(merged, found["root"] == merged["node"], "left").withColumn("root", F.coalesce("into", "root"))
        found = stored(found.select("doc_id", "_hash", "root"))
    best = found.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "_hash")).alias("b"))
    best = best.select(F.col("b.doc_id").alias("best_id"), F.col("b._hash").alias("best_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("_hash") == F.col("best_hash"))
    rows = hashed.join(best, same, "left_semi")
    if not found.groupBy("doc_id", "_hash").count().filter("count > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "_hash"])
    return rows.drop("_hash")
