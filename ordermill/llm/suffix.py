"""Removal of long repeated byte strings by sparse suffix sorting with bucket pointers.

What has to be known is which strings of ``LENGTH`` bytes start more than once. Sorting all suffixes
would shuffle every byte position, so suffixes are sampled: the starts whose strings have the same
smallest 32-byte name share that place as their anchor. Equal strings have their anchor at the same
place, so they meet in the anchor's bucket. About one position in 60 is an anchor.

Names stand for bucket identifiers. A bucket of q-grams is named by a hash of its q = 8 bytes. A bucket
of twice the depth is named by its name at this offset and the one at the later offset, so each round
reuses the names the round before has made, from 8 to 16, 32, 64 and 128 bytes and to the whole length.
Refinement goes on only in buckets that still hold several suffixes:

1. all anchors, by their 32 bytes: an anchor that is alone in its bucket is done, its starts are unique;
2. the anchors left, by all bytes that their starts' strings cover: equal ones are repeated as a whole;
3. of those a single one, start by start, by the names of the whole length, against one anchor of each
   kind in the bucket. For this one anchor of a kind, with the bytes its starts cover (at most 368),
   goes to its bucket's task; a bucket of more than ``MOST_KINDS`` kinds is refined further, by start.

No large bucket is gathered: steps count by name, which is combined before the shuffle, and join back by
name, an equi-join that Spark may split. Names have 64 bits and are compared within a bucket of a 64-bit
name, so a chance equality that would remove bytes wrongly has odds of about one in 2^64 a bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ordermill.llm.common import slices, stored, whole_texts

LENGTH = 200
Q = 32
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _MIX
    x ^= x >> np.uint64(29)
    x *= _MULTIPLY
    x ^= x >> np.uint64(32)
    return x


def paired(first: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Name of what has the name ``first`` and, at a later offset, the name ``later``."""
    return _mixed(first * _MULTIPLY + later)


def bucket_names(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the strings of ``Q`` and of ``LENGTH`` bytes that start at each position of ``raw``."""
    n = len(raw)
    grams = np.ndarray((n - 7,), "<u8", buffer=raw, strides=(1,))
    names, depth, initial = _mixed(grams), 8, None
    while depth < 128:
        names = paired(names[:-depth], names[depth:])
        depth *= 2
        if depth == Q:
            initial = names
    rest = LENGTH - depth
    return initial, paired(names[: n - LENGTH + 1], names[rest : n - LENGTH + 1 + rest])


def window_anchors(initial: np.ndarray, n_starts: int) -> np.ndarray:
    """For each start, the position of the smallest initial name in its string, the leftmost of equals."""
    bits = np.uint64(21)
    key = (initial >> bits << bits) | np.arange(len(initial), dtype=np.uint64)
    width, covered = LENGTH - Q + 1, 1
    while covered * 2 <= width:
        key = np.minimum(key[:-covered], key[covered:])
        covered *= 2
    rest = width - covered
    return (np.minimum(key[:n_starts], key[rest : rest + n_starts]) & np.uint64((1 << 21) - 1)).astype(np.int64)


# A long text is cut into chunks that overlap, so that every start is in just one of them.
_CHUNK = 1 << 20


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Bytes of whole texts or parts of long ones, and (text, place in it, first, number of starts) in them."""
    rest: list[bytes] = []
    places: list[tuple[int, int, int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, _CHUNK):
            part = text[at : at + _CHUNK + LENGTH - 1]
            if size and size + len(part) > _CHUNK:
                yield np.frombuffer(b"".join(rest), np.uint8), places
                rest, places, size = [], [], 0
            places.append((i, at, size, len(part) - LENGTH + 1))
            rest.append(part)
            size += len(part)
    if size:
        yield np.frombuffer(b"".join(rest), np.uint8), places


def _found_anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, anchor, bucket, name of all covered bytes, anchor - first start, anchor - last start)."""
    for raw, places in _chunks(texts):
        initial, names = bucket_names(raw)
        anchor = window_anchors(initial, len(names))
        of = np.full(len(names), -1)
        shift = np.zeros(len(names), np.int64)
        for i, at, first, n in places:
            of[first : first + n] = i
            shift[first : first + n] = at - first
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (of[1:] != of[:-1])]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(names)] - 1
        inside = of[first] >= 0
        first, last = first[inside], last[inside]
        at = anchor[first]
        back, forth = at - first, at - last
        extent = (back << 16 | forth + (1 << 15)).astype(np.uint64)
        whole = paired(paired(names[first], names[last]), extent)
        yield of[first], at + shift[first], initial[at].view(np.int64), whole.view(np.int64), back, forth


def _texts_with_key(docs: DataFrame, *others: str) -> DataFrame:
    """Rows are told apart by ``doc_id`` and, where it is null or repeated, 126 bits that a text is digested to.

    A null id takes half of the digest in its place; the lowest bit of ``check`` tells null ids from others.
    """
    half = F.xxhash64(F.lit(1), "text")
    return whole_texts(docs, *others).select(
        F.coalesce(F.col("doc_id").cast("long"), half).alias("id"),
        F.shiftleft(F.xxhash64(F.lit(2), "text"), 1).bitwiseOR(F.isnull("doc_id").cast("long")).alias("check"),
        "doc_id",
        *others,
        "text",
    )


_KEY = ["id", "check"]


def _anchors(texts: DataFrame) -> DataFrame:
    """``id``, ``check``, ``bucket``, ``whole``, ``place`` of every anchor; ``place`` holds it and its first and last start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                raw = [t.as_buffer().to_pybytes() for t in part.column("text")]
                found = [np.concatenate(x) for x in zip(*_found_anchors(raw), strict=True)] or [np.zeros(0, np.int64)] * 6
                of, at, bucket, whole, back, forth = found
                place = at << 24 | back << 12 | forth + (1 << 11)
                rows = pa.array(of)
                key = [part.column(c).take(rows) for c in _KEY]
                yield pa.RecordBatch.from_arrays(
                    [*key, pa.array(bucket), pa.array(whole), pa.array(place)], names=[*_KEY, "bucket", "whole", "place"]
                )

    fields = "id long, check long, bucket long, whole long, place long"
    return texts.select(*_KEY, "text").mapInArrow(run, fields)


def _extents(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of each anchor."""
    at = place >> 24
    return at - (place >> 12 & 0xFFF), at - ((place & 0xFFF) - (1 << 11))


def _zipped(texts: DataFrame) -> DataFrame:
    """The texts compressed for the shuffle, to less than half of their size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            for part in slices(batch):
                raw = [t.as_buffer() for t in part.column("text")]
                zipped = pa.array([codec.compress(r, asbytes=True) if r.size else b"" for r in raw], pa.binary())
                size = pa.array([r.size for r in raw], pa.int64())
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*kept.columns, size, zipped], names=[*kept.schema.names, "size", "zipped"])

    kept = texts.drop("text").schema.simpleString()[len("struct<") : -1].replace(":", " ")
    return texts.mapInArrow(run, kept + ", size long, zipped binary")


def _unzipped(row: dict) -> bytes:
    return pa.Codec("zstd").decompress(row["zipped"], row["size"], asbytes=True) if row["size"] else b""


def _with_bytes(texts: DataFrame, open_kinds: DataFrame) -> DataFrame:
    """Adds to the anchors (``id``, ``check``, ``bucket``, ``place``, ``single``) the bytes their starts cover."""
    asked = open_kinds.groupBy(*_KEY).agg(F.collect_list(F.struct("bucket", "place", "single", "hot")).alias("asked"))
    joined = _zipped(texts.select(*_KEY, "text")).join(asked, _KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(at, 64).to_pylist():
                    text = _unzipped(row)
                    asked = row["asked"]
                    first, last = _extents(np.array([a["place"] for a in asked], np.int64))
                    for a, x, y in zip(asked, first.tolist(), last.tolist(), strict=True):
                        out.append((row["id"], row["check"], *a.values(), text[x : y + LENGTH]))
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64()] * 4 + [pa.bool_()] * 2 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    names = [*_KEY, "bucket", "place", "single", "hot", "bytes"]
    return joined.mapInArrow(run, "id long, check long, bucket long, place long, single boolean, hot boolean, bytes binary")


def _names_of(covered: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Names of all whole-length strings in each of some byte strings, and which of these they are in."""
    raw = np.frombuffer(b"".join(covered), np.uint8)
    sizes = np.array([len(c) for c in covered])
    counts = sizes - LENGTH + 1
    of = np.repeat(np.arange(len(covered)), counts)
    within = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    return bucket_names(raw)[1][np.repeat(np.cumsum(sizes) - sizes, counts) + within], of


def _resolved(groups: DataFrame) -> DataFrame:
    """Repeated starts of single anchors, in buckets that a task can hold: ``id``, ``check``, ``first``, ``last``."""

    def solve(rows: list[dict]) -> list[tuple]:
        names, of = _names_of([r["bytes"] for r in rows])
        # A string starts once at most in what an anchor covers, so equal names are of different anchors.
        bucket = np.array([r["bucket"] for r in rows], np.int64)[of]
        order = np.lexsort((names, bucket))
        same = (bucket[order][1:] == bucket[order][:-1]) & (names[order][1:] == names[order][:-1])
        repeated = np.zeros(len(names), bool)
        repeated[order] = np.r_[False, same] | np.r_[same, False]
        repeated &= np.array([r["single"] for r in rows], bool)[of]
        first, _ = _extents(np.array([r["place"] for r in rows], np.int64))
        start = first[of] + np.arange(len(of)) - np.searchsorted(of, of)
        begin = repeated & ~np.r_[False, repeated[:-1] & (of[1:] == of[:-1])]
        end = repeated & ~np.r_[repeated[1:] & (of[1:] == of[:-1]), False]
        return [
            (rows[i]["id"], rows[i]["check"], a, z)
            for i, a, z in zip(of[begin].tolist(), start[begin].tolist(), start[end].tolist(), strict=True)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                held += batch.slice(at, 2048).to_pylist()
                last = held[-1]["bucket"]
                cut = next((i for i in range(len(held) - 1, -1, -1) if held[i]["bucket"] != last), -1) + 1
                if cut:
                    yield batch_of(solve(held[:cut]))
                    held = held[cut:]
        if held:
            yield batch_of(solve(held))

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[*_KEY, "first", "last"])

    dealt = groups.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.select(*_KEY, "bucket", "place", "single", "bytes").mapInArrow(run, "id long, check long, first long, last long")


def _resolved_by_start(groups: DataFrame) -> DataFrame:
    """The same for buckets of any size: one row per start, counted by bucket and name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                names, of = _names_of(part.column("bytes").to_pylist())
                first, _ = _extents(part.column("place").to_numpy())
                start = first[of] + np.arange(len(of)) - np.searchsorted(of, of)
                kept = part.drop_columns(["place", "bytes"]).take(pa.array(of))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(start), pa.array(names.view(np.int64))],
                    names=[*kept.schema.names, "first", "name"],
                )

    fields = "id long, check long, bucket long, single boolean, first long, name long"
    starts = groups.select(*_KEY, "bucket", "single", "place", "bytes").mapInArrow(run, fields)
    counted = starts.groupBy("bucket", "name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = starts.filter("single").join(counted, ["bucket", "name"])
    return found.select(*_KEY, "first", F.col("first").alias("last"))


#: Kinds of anchors of a bucket that one task compares; larger buckets are refined start by start.
MOST_KINDS = 8192


def repeated_starts(texts: DataFrame, most_kinds: int = MOST_KINDS) -> DataFrame:
    """``id``, ``check``, ``spans``: per text the runs (first, last) of starts whose strings start elsewhere as well."""
    anchors = _anchors(texts)
    # Stored, so that it isn't computed on the join's own partitions, where Spark couldn't split a hot bucket.
    several = stored(anchors.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket"))
    left = stored(anchors.join(several, "bucket"))
    kinds = left.groupBy("bucket", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*_KEY, "place")).alias("one")
    )
    kinds = stored(kinds.select("bucket", "one.*", (F.col("n") == 1).alias("single")))
    # Only a single kind is in question, and only if its bucket has another one.
    mixed = kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.max("single").alias("any"))
    mixed = stored(mixed.filter("k > 1 AND any").select("bucket", (F.col("k") > most_kinds).alias("hot")))
    covered = _with_bytes(texts, kinds.join(mixed, "bucket").select(*_KEY, "bucket", "place", "single", "hot"))
    covered = stored(covered)
    found = _resolved(covered.filter("NOT hot")).unionByName(_resolved_by_start(covered.filter("hot")))

    low = 1 << 12
    first = F.shiftright("place", 24) - F.shiftright("place", 12).bitwiseAND(F.lit(low - 1))
    last = F.shiftright("place", 24) - (F.col("place").bitwiseAND(F.lit(low - 1)) - F.lit(1 << 11))
    alone = kinds.filter("single").select(*_KEY, "place")
    whole = left.select(*_KEY, "place").join(alone, [*_KEY, "place"], "left_anti")
    spans = whole.select(*_KEY, first.alias("first"), last.alias("last")).unionByName(found)
    return spans.groupBy(*_KEY).agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def removed_runs(spans: list[dict], size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings starting in ``spans`` cover."""
    runs: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + LENGTH)
        else:
            runs.append([first, last + LENGTH])
    return [(a, z) for a, z in runs]


def on_characters(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs without the characters they only cut, so that what is left is valid UTF-8."""
    whole = []
    for a, z in runs:
        while a < z and raw[a] & 0xC0 == 0x80:
            a += 1
        while z > a and z < len(raw) and raw[z] & 0xC0 == 0x80:
            z -= 1
        if a < z:
            whole.append((a, z))
    return whole


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(x for run in runs for x in run), len(raw)]
    return b"".join(raw[a:z] for a, z in zip(ends[::2], ends[1::2], strict=True))


def _edited(docs: DataFrame, others: list[str], edit, fields: str) -> DataFrame:
    """``others`` of every row and what ``edit`` makes of its text and removed runs."""
    texts = _texts_with_key(docs)
    rows = _zipped(_texts_with_key(docs, *others)).join(repeated_starts(texts), _KEY, "left")
    kept = [c for c in rows.columns if c not in (*_KEY, "size", "zipped", "spans")]
    schema = rows.select(*kept).schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", " + fields
    added = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = []
                for row in part.select(["size", "zipped", "spans"]).to_pylist():
                    raw = _unzipped(row)
                    found.append(edit(raw, removed_runs(row["spans"] or [], len(raw))))
                values = [pa.array(v, t) for v, t in zip(zip(*found, strict=True), added.types, strict=True)]
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, *values], names=kept + added.names)

    return rows.mapInArrow(run, schema)


def removal_report(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``: what removal does to its text.

    A null text counts as empty; texts under ``LENGTH`` bytes lose nothing; rows that repeat as a whole
    lose every string they share, as any other copies do; an empty table gives no rows; other columns
    are ignored.
    """

    def edit(raw: bytes, runs: list[tuple[int, int]]) -> tuple:
        removed = sum(z - a for a, z in runs)
        return len(raw), removed, len(runs), hashlib.sha256(_kept(raw, runs)).hexdigest()

    fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _edited(docs, [], edit, fields)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns of documents) with repeated bytes taken from ``text``, ``n_chars`` counted anew.

    Characters of which only a part is repeated stay. A null text stays null, if nothing else is known of it.
    """

    def edit(raw: bytes, runs: list[tuple[int, int]]) -> tuple:
        text = _kept(raw, on_characters(raw, runs)).decode("utf-8")
        return text, len(text)

    flagged = docs.withColumn("_null", F.isnull("text"))
    rows = _edited(flagged, ["lang", "source", "_null"], edit, "text string, n_chars long")
    known = [F.when(~F.col("_null"), F.col(c)).alias(c) for c in ("text", "n_chars")]
    return rows.select("doc_id", known[0], "lang", "source", known[1])
