"""Document fingerprints as invertible Bloom lookup tables over paragraphs.

A text is a multiset of paragraph digests (the nth copy of a paragraph counts as one of its own). Each
digest goes to one cell in each of three parts of a table; a cell holds how many digests it got, their
exclusive or, and the exclusive or of their checksums. Tables of one size subtract cell by cell, and what
both texts have cancels. A cell left with one digest gives it away, which takes it out of its other cells,
and so on: if all cells end empty, the differing digests are known. If not, the difference is built again
in a table for as many digests as both texts have, and then in larger ones. The likeness of two texts is the share of their digests that don't differ.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import slices, whole_texts

#: Cells of a fingerprint; a difference of about eight paragraphs can be read from it.
CELLS = 12
GROWTH = 2
PARTS = 3
_SEEDS = np.array([[0x9E3779B97F4A7C15], [0xC2B2AE3D27D4EB4F], [0x165667B19E3779F9]], np.uint64)
_ROWS = np.arange(PARTS, dtype=np.int64)[:, None]
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_AGAIN = np.uint64(0xC4CEB9FE1A85EC53)
_CHECK = np.uint64(0xD6E8FEB86659FD93)


def paragraphs(text: str) -> list[bytes]:
    """Pieces of a text, cut at line ends, behind sentences, and within long ones where their bytes say so.

    A piece in running text also ends at a space when the four bytes before it hash to a multiple of 16, and
    anywhere when they hash to a multiple of 512, so that an edit changes the pieces near it only.
    """
    raw = text.encode("utf-8")
    if len(raw) < 5:
        return [raw] if raw.strip() else []
    b = np.frombuffer(raw, np.uint8)
    four = np.ndarray((len(raw) - 3,), "<u4", buffer=raw, strides=(1,))
    mixed = (four * np.uint32(0x9E3779B1)) >> np.uint32(16)
    cut = b == 10
    space = b[1:] == 32
    cut[1:] |= space & ((b[:-1] == 46) | (b[:-1] == 33) | (b[:-1] == 63))
    before = mixed[:-1]  # of the four bytes before each position from the fourth on
    cut[4:] |= (before % 512 == 0) | ((b[4:] == 32) & (before % 16 == 0))
    ends = [0, *np.flatnonzero(cut).tolist(), len(raw)]
    return [p for s, e in zip(ends, ends[1:], strict=False) if (p := raw[s:e].strip())]


def digests(text: str) -> np.ndarray:
    """64-bit digest of each paragraph and of how often it came before."""
    seen: dict[bytes, int] = {}
    out = []
    digest = xxhash.xxh64_intdigest
    for p in paragraphs(text):
        n = seen.get(p, 0)
        seen[p] = n + 1
        out.append(digest(p, n))
    return np.array(out, np.uint64)


def _checksums(keys: np.ndarray) -> np.ndarray:
    x = keys * _CHECK
    return (x ^ (x >> np.uint64(29))) >> np.uint64(16) & np.uint64(0xFFFFFFFF)


def _cells_of(keys: np.ndarray, cells: int) -> np.ndarray:
    """A row for each part of the table, with the cell of each key."""
    x = (keys ^ _SEEDS) * _MIX
    x = (x ^ (x >> np.uint64(33))) * _AGAIN
    part = cells // PARTS
    return ((x >> np.uint64(20)) % np.uint64(part)).astype(np.int64) + _ROWS * part


def _in_each_part(values: np.ndarray) -> np.ndarray:
    return np.concatenate([values] * PARTS)


@dataclass
class Table:
    counts: np.ndarray
    keys: np.ndarray
    checks: np.ndarray

    @classmethod
    def of(cls, plus: np.ndarray, cells: int = CELLS, minus: np.ndarray | None = None) -> Table:
        """Table of some digests, less that of others: the difference of their tables."""
        signs = None
        if minus is not None:
            signs = _in_each_part(np.r_[np.ones(len(plus)), -np.ones(len(minus))])
            plus = np.concatenate([plus, minus])
        at = _cells_of(plus, cells).ravel()
        counts = np.bincount(at, signs, cells).astype(np.int64)
        table = cls(counts, np.zeros(cells, np.uint64), np.zeros(cells, np.uint64))
        np.bitwise_xor.at(table.keys, at, _in_each_part(plus))
        np.bitwise_xor.at(table.checks, at, _in_each_part(_checksums(plus)))
        return table

    def __sub__(self, other: Table) -> Table:
        return Table(self.counts - other.counts, self.keys ^ other.keys, self.checks ^ other.checks)

    def size(self) -> int:
        """Number of digests in the table."""
        return int(self.counts.sum()) // PARTS

    def text(self) -> str:
        raw = self.counts.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes() + self.checks.astype("<u4").tobytes()
        return base64.b64encode(raw).decode("ascii")

    def peeled(self) -> int | None:
        """How many digests the table holds with either sign, or None if they can't all be recovered."""
        counts, keys, checks = self.counts.copy(), self.keys.copy(), self.checks.copy()
        found = 0
        while True:
            alone = np.flatnonzero(np.abs(counts) == 1)
            alone = alone[_checksums(keys[alone]) == checks[alone]]
            if not len(alone):
                break
            new, first = np.unique(keys[alone], return_index=True)
            at = _cells_of(new, len(counts)).ravel()
            np.subtract.at(counts, at, _in_each_part(counts[alone[first]]))
            np.bitwise_xor.at(keys, at, _in_each_part(new))
            np.bitwise_xor.at(checks, at, _in_each_part(_checksums(new)))
            found += len(new)
        return None if counts.any() or keys.any() or checks.any() else found


def differences(a: np.ndarray, b: np.ndarray, table_a: Table, table_b: Table) -> int:
    """Number of digests that only one of two texts has, from their tables, larger ones if need be."""
    found = (table_a - table_b).peeled()
    cells = PARTS * ((len(a) + len(b)) // 2 + CELLS)
    while found is None:
        found = Table.of(a, cells, b).peeled()
        cells *= GROWTH
    return found


@dataclass
class Document:
    """A text with what its fingerprint is made of."""

    text: str
    keys: np.ndarray
    table: Table

    @classmethod
    def of(cls, text: str) -> Document:
        keys = digests(text)
        return cls(text, keys, Table.of(keys))

    def likeness(self, other: Document) -> float:
        if self.text == other.text:
            return 1.0
        both = self.table.size() + other.table.size()
        return 1.0 - differences(self.keys, other.keys, self.table, other.table) / both if both else 1.0


def edited_with(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _range_firsts(docs: DataFrame, ranges: int) -> list[tuple]:
    """First rows (named, doc_id, mark) of ranges in descending order: a bounded number of ids."""
    keys = docs.select(
        F.isnotnull("doc_id").alias("named"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
    )
    dealt = keys.repartitionByRange(ranges, F.desc("named"), F.desc("id"), F.desc("mark"))
    firsts = dealt.groupBy(F.spark_partition_id()).agg(F.max(F.struct("named", "id", "mark")).alias("first"))
    return sorted({tuple(r["first"]) for r in firsts.collect()}, reverse=True)


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per row ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The next document is the one with the next smaller ``doc_id``; of repeated ids the order goes by the text's
    hash, and null ids come last; behind the last row comes the first. A null text counts as empty; two
    texts without a paragraph are alike; repeated rows stay; an empty table gives no rows; other columns
    are ignored.

    Rows are dealt into ranges of ids, compressed, and read in order; the first row of the next range goes
    along as a guest. Only the ranges' first ids, as many as ``ranges``, reach the driver.
    """
    session = docs.sparkSession
    ranges = ranges or 8 * int(session.conf.get("spark.sql.shuffle.partitions"))
    firsts = _range_firsts(docs, ranges)
    texts = whole_texts(docs).select(F.isnotnull("doc_id").alias("named"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), "text")
    texts = texts.select("named", "id", F.xxhash64("text").alias("mark"), "text")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        before = {first: (place - 1) % len(firsts) for place, first in enumerate(firsts)}
        # Ascending order for the search: a row belongs to the first range that starts at it or above it.
        keys = np.array(firsts[::-1], dtype=[("named", bool), ("id", np.int64), ("mark", np.int64)])
        for batch in batches:
            for part in slices(batch):
                rows = list(zip(*(part.column(c).to_pylist() for c in ("named", "id", "mark")), strict=True))
                asked = np.array(rows, dtype=keys.dtype)
                place = len(firsts) - 1 - np.searchsorted(keys, asked, side="left")
                zipped = []
                sizes = []
                for t in part.column("text"):
                    raw = t.as_buffer()
                    sizes.append(raw.size)
                    zipped.append(codec.compress(raw, asbytes=True) if raw.size else b"")
                guests = [i for i, r in enumerate(rows) if r in before]
                of = [*range(len(rows)), *guests]
                columns = [pa.array([*place.tolist(), *(before[rows[i]] for i in guests)], pa.int32())]
                columns.append(pa.array([False] * len(rows) + [True] * len(guests)))
                columns += [part.column(c).take(pa.array(of, pa.int64())) for c in ("named", "id", "mark")]
                columns.append(pa.array([sizes[i] for i in of], pa.int64()))
                columns.append(pa.array([zipped[i] for i in of], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["place", "guest", "named", "id", "mark", "size", "zipped"]
    dealt = texts.mapInArrow(deal, "place int, guest boolean, named boolean, id long, mark long, size long, zipped binary")
    ordered = dealt.repartition("place").sortWithinPartitions("place", "guest", F.desc("named"), F.desc("id"), F.desc("mark"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        waiting: tuple[int, int | None, Document] | None = None
        served = -1  # range whose guest has come
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(at, 256).to_pylist():
                    if r["guest"] and r["place"] == served:
                        continue
                    text = codec.decompress(r["zipped"], r["size"], asbytes=True).decode("utf-8") if r["size"] else ""
                    now = Document.of(text)
                    if waiting is not None and waiting[0] == r["place"]:
                        out.append((waiting[1], *_row(waiting[2], now)))
                    served = r["place"] if r["guest"] else served
                    waiting = None if r["guest"] else (r["place"], r["id"] if r["named"] else None, now)
                columns = list(zip(*out, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=result)

    result = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    fields = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
    return ordered.mapInArrow(compare, fields + ", near_edited double, near_next double")


def _row(doc: Document, following: Document) -> tuple:
    edited = Document.of(edited_with(doc.text, following.text))
    sha = hashlib.sha256(edited.text.encode("utf-8")).hexdigest()
    return len(doc.text), sha, doc.table.text(), edited.table.text(), doc.likeness(edited), doc.likeness(following)
