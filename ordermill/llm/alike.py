"""Links between texts that share most of their shingles.

Texts meet where they agree in one of ``MEETINGS`` smallest hashes of their shingles, each under an order of its
own; two texts with a Jaccard similarity of 0.8 miss each other in all of them once in 250 million times, more
similar ones more rarely. Only a sketch travels to the meeting: a bit for each slot of shingle hashes, turned
over by every shingle that falls there. Bits that differ are shingles that differ, so a pair whose sketches
differ in more bits than similar texts of their sizes may is no link, for certain.

Each meeting names the texts whose sketches allow another text that is apart; whole sets are made for them only.
First such a text goes with the one before it whose sketch is nearest to its own, which joins most groups of near
copies, and the meetings name what is still apart. The whole sets of that are dealt to their meetings, all pairs still
allowed are compared there, each in the first meeting the two have in common, and links that join what is apart
are put out, a forest for each task. So no step puts out pairs by the square of a meeting's size. A meeting of
very many texts is dealt into pairs of blocks, so that no task holds all of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import slices, stored, written
from ordermill.llm.components import components

SEED = 42
MEETINGS = 12
#: Texts of a meeting that are compared in one place.
BLOCK = 2048
#: Shingles of whole sets that are compared in one place.
BLOCK_SHINGLES = 1 << 20
#: Bits of a sketch, at least and at most; in between, the next power of two from the number of shingles on.
LEAST_BITS, MOST_BITS = 256, 1 << 14
#: Instead of a number of bits: the texts can't be alike, or are joined already.
_NEVER = np.uint16(0xFFFF)
_FACTORS = (np.random.default_rng(SEED).integers(0, 1 << 63, MEETINGS, np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of all words if there are fewer."""
    found = text.encode("utf-8").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    return np.unique(np.frombuffer(b"".join([xxhash.xxh64_digest(s, SEED) for s in joined]), ">u8").astype(np.uint64))


def are_alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted sets is 0.8 or more."""
    if not 4 * max(len(x), len(y)) <= 5 * min(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 5 * both >= 4 * (len(x) + len(y) - both)


def sketch(found: np.ndarray) -> bytes:
    """Parities of the shingles in each slot."""
    bits = min(max(LEAST_BITS, 1 << max(len(found) - 1, 0).bit_length()), MOST_BITS)
    odd = np.bincount((found >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches, a row each, with fewer slots."""
    while sketches.shape[1] > width:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def meeting_hashes(found: np.ndarray) -> np.ndarray:
    """The smallest hash under each order, made different between the orders."""
    mixed = found[None, :] * _FACTORS[:, None]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed.min(axis=1) ^ _FACTORS


def _new_rows(part: pa.RecordBatch, seen: set[int]) -> list[tuple[int, str]]:
    """Ids that the task hasn't met (or hasn't met for long), with their texts."""
    rows = []
    for id_, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
        if id_ not in seen:
            if len(seen) > 1_000_000:
                seen.clear()
            seen.add(id_)
            rows.append((id_, text or ""))
    return rows


def _meetings(texts: DataFrame, words: int) -> DataFrame:
    """``value``, ``n``, ``id``, ``sketch``; a text that a task meets again is put out once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                rows = []
                for id_, text in _new_rows(part, seen):
                    found = shingles(text, words)
                    if len(found):
                        rows.append((meeting_hashes(found).view(np.int64), len(found), id_, sketch(found)))
                if rows:
                    values, n, ids, sketches = zip(*rows, strict=True)
                    each = np.repeat(np.arange(len(rows)), MEETINGS)
                    columns = [pa.array(np.concatenate(values)), pa.array(np.array(n, np.int64)[each])]
                    columns += [pa.array(np.array(ids, np.int64)[each]), pa.array(sketches, pa.binary()).take(pa.array(each))]
                    yield pa.RecordBatch.from_arrays(columns, names=["value", "n", "id", "sketch"])

    return texts.select("id", "text").mapInArrow(run, "value long, n long, id long, sketch binary")


def _in_blocks(met: DataFrame, every: bool, carried: str = "sketch") -> DataFrame:
    """Rows by ``value``, ``low`` and ``high``: blocks of a meeting that are to be compared, and the row's ``block``.

    A text is in other company in each meeting. With ``every``, each block of a meeting goes with each other; else
    only with itself, so every row is dealt once. ``carried`` is the column that is compared; blocks of whole sets
    are smaller where texts are long.
    """
    size = F.count(F.lit(1)) / BLOCK
    if carried != "sketch":
        size = F.greatest(size, F.sum("n") / BLOCK_SHINGLES)
    many = met.groupBy("value").agg(F.ceil(size).cast("int").alias("blocks")).filter("blocks > 1")
    dealt = met.join(many, "value", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id", "value"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if every else F.col("block")
    dealt = dealt.select("value", "n", "id", "root", carried, "block", others.alias("other"))
    return dealt.select(
        "value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "n", "id", "root", carried
    )


def _bits_apart(n: np.ndarray, sketches: list[bytes], rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Bits in which the sketches of ``rows`` and ``others`` differ, as a matrix; ``_NEVER`` where they rule out 0.8."""
    found = np.full((len(rows), len(others)), _NEVER)
    widths = np.array([len(s) for s in sketches])
    for a in np.unique(widths[rows]):
        for b in np.unique(widths[others]):
            if max(a, b) > 2 * min(a, b):
                continue
            i, j = rows[widths[rows] == a], others[widths[others] == b]
            width = int(min(a, b))
            x = _folded(np.frombuffer(b"".join([sketches[k] for k in i]), np.uint8).reshape(len(i), a), width).view(np.uint64)
            y = _folded(np.frombuffer(b"".join([sketches[k] for k in j]), np.uint8).reshape(len(j), b), width).view(np.uint64)
            apart = np.zeros((len(i), len(j)), np.uint16)
            for word in range(x.shape[1]):
                apart += np.bitwise_count(x[:, word, None] ^ y[None, :, word])
            sizes, other_sizes = n[i][:, None], n[j][None, :]
            fits = (apart <= (sizes + other_sizes) // 9) & (5 * sizes >= 4 * other_sizes) & (5 * other_sizes >= 4 * sizes)
            found[np.ix_(widths[rows] == a, widths[others] == b)] = np.where(fits, apart, _NEVER)
    return found


def _allowed(n: np.ndarray, sketches: list[bytes], rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether the sketches of ``rows`` and ``others`` leave a similarity of 0.8 possible, as a matrix."""
    return _bits_apart(n, sketches, rows, others) != _NEVER


def _each_meeting(dealt: DataFrame, work: Callable[[tuple, pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``work`` makes of the texts of each ``value``, ``low``, ``high`` that aren't all joined, by size and id."""

    def met(key: tuple, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        ids = table.column("id").to_numpy()
        # Copies that came from several tasks stand side by side.
        new = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        roots = table.column("root").to_numpy()[new]
        if (roots != roots[0]).any():
            yield from work(key, table.take(pa.array(new)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["value", "low", "high"]
        held, key = [], None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in names]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if batch.num_rows else []
            for s, e in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if s == e:
                    continue
                now = tuple(int(c[s]) for c in columns)
                if now != key and held:
                    if sum(h.num_rows for h in held) > 1:
                        yield from met(key, held)
                    held = []
                key = now
                held.append(batch.slice(s, e - s))
        if held:
            yield from met(key, held)

    keys = ["value", "low", "high"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "n", "id").mapInArrow(run, schema)


def _pairs(dealt: DataFrame, every: bool) -> DataFrame:
    """``value``, ``u``, ``v``, ``apart``: texts that meet, are apart and may be alike.

    Each text ``u`` with the nearest such ``v`` before it; with ``every``, also texts ``v`` that are in no pair
    so far, so each text that may be like another is in one.
    """

    def nearest(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        value, low, high = key
        n, ids, roots, blocks = (table.column(c).to_numpy() for c in ("n", "id", "root", "block"))
        sketches = table.column("sketch").to_pylist()
        left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
        named = np.zeros(len(ids), bool)
        for at in range(0, len(right), 256):
            rows = right[at : at + 256]
            apart = _bits_apart(n, sketches, rows, left)
            apart[roots[rows][:, None] == roots[left][None, :]] = _NEVER
            if low == high:
                apart[left[None, :] >= rows[:, None]] = _NEVER
            if (apart == _NEVER).all():
                continue
            j = np.argmin(apart, axis=1)
            i = np.flatnonzero(apart[np.arange(len(rows)), j] != _NEVER)
            j = j[i]
            named[rows[i]] = named[left[j]] = True
            if every:
                other = np.argmin(apart, axis=0)
                rest = np.flatnonzero((apart[other, np.arange(len(left))] != _NEVER) & ~named[left])
                named[left[rest]] = True
                i, j = np.append(i, other[rest]), np.append(j, rest)
            columns = [np.full(len(i), value, np.int64), ids[rows[i]], ids[left[j]], apart[i, j].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["value", "u", "v", "apart"])

    return _each_meeting(dealt, nearest, "value long, u long, v long, apart int")


def _named(pairs: DataFrame) -> DataFrame:
    """``value``, ``id`` of the texts in ``pairs``."""
    return pairs.select("value", F.explode(F.array("u", "v")).alias("id")).distinct()


def _joined(dealt: DataFrame) -> DataFrame:
    """``u``, ``v``: links between roots of texts that meet and are alike; for each block pair a forest of them.

    Two texts are compared where they meet first, by whole sets, unless links found here join them already.
    """

    def forest(key: tuple, table: pa.Table) -> Iterator[pa.RecordBatch]:
        value, low, high = key
        n, roots, blocks = (table.column(c).to_numpy() for c in ("n", "root", "block"))
        sets = [np.frombuffer(f, np.uint64) for f in table.column("found").to_pylist()]
        sketches = [sketch(s) for s in sets]
        meetings = np.array([meeting_hashes(s) for s in sets]).view(np.int64)
        before = meetings[:, : int(np.argmax(meetings[0] == value))]
        distinct, code = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.append(0, np.cumsum(n))
        here = np.zeros(len(distinct), bool)
        names, group = np.unique(roots, return_inverse=True)
        left, right = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
        u, v = [], []
        for at in range(0, len(right), 256):
            rows = right[at : at + 256]
            fits = _allowed(n, sketches, rows, left)
            if low == high:
                fits &= left[None, :] < rows[:, None]
            for row, may in zip(rows, fits, strict=True):
                others = left[may]
                others = others[group[others] != group[row]]
                others = others[~(before[others] == before[row]).any(axis=1)]
                if not len(others):
                    continue
                ends = np.cumsum(n[others])
                at_codes = np.repeat(starts[others] - ends + n[others], n[others]) + np.arange(ends[-1])
                own = code[starts[row] : starts[row + 1]]
                here[own] = True
                both = np.add.reduceat(here[code[at_codes]], ends - n[others], dtype=np.int64)
                here[own] = False
                for other in others[5 * both >= 4 * (n[row] + n[others] - both)]:
                    if group[other] != group[row]:
                        u.append(names[group[other]])
                        v.append(names[group[row]])
                        group[group == group[other]] = group[row]
        if u:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(u)), pa.array(np.array(v))], names=["u", "v"])

    return _each_meeting(dealt, forest, "u long, v long")


def _sets(named: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``id``, ``found``: the whole set of each text in ``named``, one for equal texts."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                rows = _new_rows(part, seen)
                if rows:
                    found = [shingles(t, words).tobytes() for _, t in rows]
                    columns = [pa.array([i for i, _ in rows], pa.int64()), pa.array(found, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "found"])

    wanted = texts.join(named.select("id").distinct(), "id").select("id", "text").mapInArrow(made, "id long, found binary")
    return stored(wanted.groupBy("id").agg(F.first("found").alias("found")))


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c) for c in ("found", "other"))
            keep = [are_alike(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)) for a, b in zip(x, y, strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("id").alias("u"), "found"), "u")
    both = both.join(sets.select(F.col("id").alias("v"), F.col("found").alias("other")), "v")
    return both.select("u", "v", "found", "other").mapInArrow(run, "u long, v long")


def links(texts: DataFrame, roots: DataFrame, words: int) -> DataFrame:
    """``u``, ``v``: links that connect the roots of texts with a similarity of 0.8 or more.

    ``texts`` has ``id`` (the same for equal texts) and ``text``, ``roots`` one ``root`` for each ``id``. A text
    without a word, null or empty, is like no other; one with fewer words than a shingle is like those with the same
    words. Copies and repeated rows are compared once; very long texts are compared whole; ties in size are ordered
    by id. An empty table gives no links; further columns are ignored.
    """
    texts = texts.select("id", "text")
    every = written(_meetings(texts, words), "meetings")
    several = every.groupBy("value").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("value")
    met = stored(every.join(several, "value").join(roots, "id").select("value", "n", "id", "root", "sketch"))

    pairs = stored(_pairs(_in_blocks(met, True), True))
    named = _named(pairs)
    sets = _sets(named, texts, words)
    nearest = pairs.groupBy("u").agg(F.min(F.struct("apart", "v")).alias("near")).select("u", "near.v")
    rooted = _alike(nearest, sets).join(roots.select(F.col("id").alias("u"), F.col("root").alias("ru")), "u")
    rooted = rooted.join(roots.select(F.col("id").alias("v"), F.col("root").alias("rv")), "v")
    found = stored(rooted.select(F.col("ru").alias("u"), F.col("rv").alias("v")).distinct())

    joined = stored(components(found)).select(F.col("node").alias("root"), F.col("root").alias("into"))
    now = met.join(named, ["value", "id"], "left_semi").join(joined, "root", "left")
    now = stored(now.withColumn("root", F.coalesce("into", "root")).select(met.columns))
    apart = stored(_named(_pairs(_in_blocks(now, True), True)))
    rooted = now.select("value", "id", "n", "root").distinct().join(apart, ["value", "id"], "left_semi")
    whole = rooted.join(sets, "id")
    return found.unionByName(stored(_joined(_in_blocks(whole, True, "found")))).distinct()
