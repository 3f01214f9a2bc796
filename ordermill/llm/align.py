"""Alignment of two tokenizers over a corpus, with an inverted index of token pairs.

Both tokenizers encode a space and the text. Where tokens of both end at the same byte a group ends, and the two
tokens that end there are linked. For every pair of ids the index holds which documents link it: documents are
numbered, ``2 ** 16`` numbers make a container, and a container's documents are a compressed bitmap (numbers while
they are few, bits otherwise). How often a document links the pair is held in planes: plane ``j`` is the bitmap of
the documents whose multiplicity has bit ``j``. Parts of a bitmap from different tasks are OR-merged; the bits of all
planes together count documents, the planes' bits weighted by ``2 ** j`` count links. A document's scores are read
back from the postings: every pair's figures are added up over the documents of its bitmaps.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import UnitCache, slices, whole_texts, written
from ordermill.llm.packing import _ids_of

#: Links that a task holds before it puts out postings, and postings that are unpacked at a time.
LINKS_AT_A_TIME = 2_000_000
#: Bytes of a bitmap; numbers take two bytes each and are used while they take less.
_BITMAP = 1 << 13

_POSTING = "a int, b int, container long, plane int, bits binary, n_docs long, n_links long"

# Where every cut at a single space is a cut between units of both tokenizers, and what units are otherwise.
_NOT_PLAIN = re.compile(r"\s |\s\Z|\A\s|[\x1c-\x1f]")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_UNIT = re.compile(r"\s*\S+(?:(?! )\s+\S+)*(?:\s+\Z)?|\s+")


class Aligner:
    """Aligns texts by a byte-level tokenizer file and a sentence-piece model.

    Texts are cut where a space follows another character that isn't white space: no token of either goes across
    such a place. Units are given without the space that each begins with.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a_width, self.a_ids = _ids_of(a_path, added=False)
        if self.a_width is None:
            raise ValueError(f"not a byte-level tokenizer with ranked merges: {a_path}")
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
            for i, p in enumerate(pieces)
        ]
        if min(map(len, self.b_bytes)) == 0:
            raise ValueError(f"a piece without bytes: {b_path}")
        self.b_width = np.array([len(p) for p in self.b_bytes], np.int64)
        probe = "  x \n  y  "
        keeps_spaces = b"".join(self.b_bytes[i] for i in self.b.encode(probe)) == b" " + probe.encode()
        self.cuts = keeps_spaces and not any(re.search("[^▁]▁", p) for p in pieces)
        self._a_text: dict[int, str] = {}

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.cuts or _ODD_SPACE.search(text):
            return [text]
        if _NOT_PLAIN.search(text):
            return [u[1:] for u in _UNIT.findall(" " + text)]
        return text.split(" ")

    def measured(self, units: list[str]) -> list[tuple | None]:
        """For each unit: counts of A tokens, B tokens and groups, pairs (64-bit numbers), groups as text.

        None for a unit whose tokens' bytes aren't the unit's. Many units are encoded as one text.
        """
        single = [u for u in units if not u or u[0].isspace() or u[-1].isspace() or _ODD_SPACE.search(u)]
        alone = set(single) if self.cuts else set(units)
        found: dict[str, tuple | None] = {u: self._joined([u])[0] for u in alone}
        together = [u for u in units if u not in alone]
        for at in range(0, len(together), 4096):
            some = together[at : at + 4096]
            values = self._joined(some)
            if values[0] is None:
                values = [self._joined([u])[0] for u in some]
            found.update(zip(some, values, strict=True))
        return [found[u] for u in units]

    def _joined(self, units: list[str]) -> list[tuple | None]:
        text = " ".join(units)
        whole = (" " + text).encode("utf-8")
        a = self.a_ids([" " + text])[0].astype(np.int64)
        b = self.b.encode(text, num_threads=1)
        if b"".join([self.b_bytes[i] for i in b]) != whole:
            return [None] * len(units)
        b = np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.a_width[a]), np.cumsum(self.b_width[b])
        if not len(a_ends) or a_ends[-1] != len(whole):
            return [None] * len(units)
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        last_a, last_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        pairs = a[last_a] << 32 | b[last_b]
        unit_ends = np.cumsum([len(u.encode("utf-8")) + 1 for u in units])
        upto = np.searchsorted(ends, unit_ends) + 1
        a_names, b_names = list(map(str, a.tolist())), list(map(str, b.tolist()))
        groups, a_at, b_at = [], 0, 0
        for i, j in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
            left = a_names[a_at] if i == a_at + 1 else ",".join(a_names[a_at:i])
            right = b_names[b_at] if j == b_at + 1 else ",".join(b_names[b_at:j])
            groups.append(f"{left}|{right}")
            a_at, b_at = i, j
        values, start, a_start, b_start = [], 0, 0, 0
        a_upto, b_upto = (last_a[upto - 1] + 1).tolist(), (last_b[upto - 1] + 1).tolist()
        for end, a_end, b_end in zip(upto.tolist(), a_upto, b_upto, strict=True):
            described = ";".join(groups[start:end]).encode("ascii")
            values.append((a_end - a_start, b_end - b_start, end - start, pairs[start:end].tobytes(), described))
            start, a_start, b_start = end, a_end, b_end
        return values


def packed_bits(keys: np.ndarray, lows: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Where each key begins, and its bitmap. ``keys`` is sorted, and ``lows`` (16-bit) within a key."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(keys))
    raw, sizes = lows.astype("<u2").tobytes(), 2 * (ends - starts)
    if len(sizes) and sizes.max() >= _BITMAP:
        parts = []
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if 2 * (e - s) < _BITMAP:
                parts.append(raw[2 * s : 2 * e])
            else:
                bits = np.zeros(8 * _BITMAP, np.uint8)
                bits[lows[s:e]] = 1
                parts.append(np.packbits(bits, bitorder="little").tobytes())
        return starts, pa.array(parts, pa.binary())
    offsets = pa.array(np.append(2 * starts, 2 * len(keys)), pa.int32())
    return starts, pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets.buffers()[1], pa.py_buffer(raw)])


def unpacked_bits(bits: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``bits`` and the numbers their bitmaps hold."""
    held = [
        np.frombuffer(b, "<u2")
        if len(b) < _BITMAP
        else np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8), bitorder="little")).astype("<u2")
        for b in bits
    ]
    sizes = [len(h) for h in held]
    return np.repeat(np.arange(len(held)), sizes), np.concatenate(held) if held else np.zeros(0, "<u2")


def _postings(keyed: dict[str, np.ndarray], key: np.ndarray, lows: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A batch for each plane. ``keyed`` holds values of keys 0, 1, ...; the other arrays are sorted by key and low.

    ``n_docs`` counts the documents whose lowest plane this is, ``n_links`` the links that the plane stands for, so
    both may be added up over planes and containers.
    """
    plane = 0
    while len(times) and times.max() >> plane:
        at = np.flatnonzero(times >> plane & 1)
        if len(at):
            starts, bits = packed_bits(key[at], lows[at])
            of = key[at[starts]]
            lowest = np.add.reduceat((times[at] & -times[at] == 1 << plane).astype(np.int64), starts)
            links = np.diff(np.append(starts, len(at))).astype(np.int64) << plane
            arrays = [pa.array(v[of]) for v in keyed.values()]
            arrays += [pa.array(np.full(len(of), plane, "i4")), bits, pa.array(lowest), pa.array(links)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keyed, "plane", "bits", "n_docs", "n_links"])
        plane += 1


class _Index:
    """Links of numbered documents, put out as postings whenever there are many."""

    def __init__(self):
        self.pairs: list[bytes] = []
        self.numbers: list[int] = []
        self.sizes: list[int] = []
        self.held = 0

    def add(self, number: int, pairs: bytes) -> None:
        self.pairs.append(pairs)
        self.numbers.append(number)
        self.sizes.append(len(pairs) // 8)
        self.held += len(pairs) // 8

    def put_out(self) -> Iterator[pa.RecordBatch]:
        pairs = np.frombuffer(b"".join(self.pairs), np.int64)
        numbers = np.repeat(np.array(self.numbers, np.int64), self.sizes)
        self.__init__()
        order = np.lexsort((numbers, pairs))
        pairs, numbers = pairs[order], numbers[order]
        first = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (numbers[1:] != numbers[:-1])))
        times = np.diff(np.append(first, len(pairs)))
        pairs, numbers = pairs[first], numbers[first]
        new = np.append(True, (pairs[1:] != pairs[:-1]) | (numbers[1:] >> 16 != numbers[:-1] >> 16))
        a, b = (pairs[new] >> 32).astype("i4"), (pairs[new] & 0xFFFFFFFF).astype("i4")
        keyed = {"a": a, "b": b, "container": numbers[new] >> 16}
        yield from _postings(keyed, np.cumsum(new) - 1, numbers & 0xFFFF, times)


_TEXT_FIELDS = ["n_a", "n_b", "n_groups", "groups_sha256"]


def _scanned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Two kinds of rows, written once: documents (``plane`` null) with their counts, and postings."""
    texts = whole_texts(docs).withColumn("number", F.monotonically_increasing_id())
    kind = texts.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "number", *_TEXT_FIELDS, "a", "b", "container", "plane", "bits", "n_docs", "n_links"]
    types = [None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    types += [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]

    def filled(known: dict, rows: int) -> pa.RecordBatch:
        arrays = [known[n] if n in known else pa.nulls(rows, t) for n, t in zip(names, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, index = Aligner(a_path, b_path), _Index()
        cache = UnitCache(aligner.measured, cut=aligner.units)

        def postings() -> Iterator[pa.RecordBatch]:
            for part in index.put_out():
                known = {n: part.column(n) for n in part.schema.names}
                yield filled(known | {"doc_id": pa.nulls(part.num_rows, types[0])}, part.num_rows)

        for batch in batches:
            types[0] = batch.schema.field("doc_id").type
            for part in slices(batch):
                rows = []
                numbers = part.column("number").to_pylist()
                for number, found in zip(numbers, cache.values(part.column("text").to_pylist()), strict=True):
                    if not found or None in found:
                        rows.append((0, 0, 0, ""))
                        continue
                    n_a, n_b, n_groups, pairs, groups = zip(*found, strict=True)
                    index.add(number, b"".join(pairs))
                    rows.append((sum(n_a), sum(n_b), sum(n_groups), hashlib.sha256(b";".join(groups)).hexdigest()))
                    if index.held >= LINKS_AT_A_TIME:
                        yield from postings()
                values = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types[2:6], strict=True)]
                known = {"doc_id": part.column("doc_id"), "number": part.column("number")}
                yield filled(known | dict(zip(_TEXT_FIELDS, values, strict=True)), len(rows))
        if index.held:
            yield from postings()

    fields = "n_a long, n_b long, n_groups long, groups_sha256 string"
    return written(texts.mapInArrow(run, f"doc_id {kind}, number long, {fields}, {_POSTING}"), "alignment")


def _in_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``keys`` in tables of a bounded number of postings; rows of one key stay together."""
    held: list[pa.RecordBatch] = []
    size, before = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        new = np.append(before != [c[0] for c in columns], np.any([c[1:] != c[:-1] for c in columns], axis=0))
        before = [c[-1] for c in columns]
        widths = pc.binary_length(batch.column("bits")).to_numpy()
        starts = np.union1d([0], np.flatnonzero(new))
        sizes = np.add.reduceat(np.where(widths < _BITMAP, widths // 2, 8 * _BITMAP), starts)
        begin = 0
        for start, more, fresh in zip(starts.tolist(), sizes.tolist(), new[starts].tolist(), strict=True):
            if fresh and size >= LINKS_AT_A_TIME:
                held.append(batch.slice(begin, start - begin))
                yield pa.Table.from_batches(held)
                held, size, begin = [], 0, start
            size += more
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def merged_index(postings: DataFrame) -> DataFrame:
    """One posting per pair, container and plane: bitmaps that come from different places are OR-merged."""
    keys = ["a", "b", "container"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _in_runs(batches, keys):
            columns = {k: rows.column(k).to_numpy() for k in keys}
            first = np.append(True, np.any([c[1:] != c[:-1] for c in columns.values()], axis=0))
            row, lows = unpacked_bits(rows.column("bits").to_pylist())
            key = (np.cumsum(first) - 1)[row]
            at, inverse = np.unique(key << 16 | lows, return_inverse=True)
            times = np.bincount(inverse, weights=2.0 ** rows.column("plane").to_numpy()[row]).astype(np.int64)
            yield from _postings({k: c[first] for k, c in columns.items()}, at >> 16, at & 0xFFFF, times)

    dealt = postings.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, _POSTING)


def pair_counts(index: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n_docs``, ``n_links`` over the corpus, and ``best``: no pair of ``b`` has more links."""
    counts = index.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    most = counts.groupBy("b").agg(F.max("n_links").alias("most"))
    return counts.join(most, "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def scores(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """``number``, ``n_best``, ``count_sum`` of each document with links, added up over the postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best, total = None, None, None

        def done() -> pa.RecordBatch:
            at = np.flatnonzero(total)
            arrays = [pa.array((current << 16) + at), pa.array(best[at]), pa.array(total[at])]
            return pa.RecordBatch.from_arrays(arrays, names=["number", "n_best", "count_sum"])

        for batch in batches:
            containers = batch.column("container").to_numpy()
            cuts = [0, *(np.flatnonzero(containers[1:] != containers[:-1]) + 1).tolist(), batch.num_rows]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if containers[s] != current:
                    if current is not None:
                        yield done()
                    current, best, total = int(containers[s]), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
                for at in range(s, e, 256):
                    part = batch.slice(at, min(256, e - at))
                    row, lows = unpacked_bits(part.column("bits").to_pylist())
                    times = np.int64(1) << part.column("plane").to_numpy().astype(np.int64)
                    np.add.at(best, lows, (times * part.column("best").to_numpy(zero_copy_only=False))[row])
                    np.add.at(total, lows, (times * part.column("links").to_numpy())[row])
        if current is not None:
            yield done()

    figures = pairs.select("a", "b", F.col("n_links").alias("links"), "best")
    scored = index.select("a", "b", "container", "plane", "bits").join(figures, ["a", "b"])
    dealt = scored.select("container", "plane", "bits", "links", "best").repartition("container").sortWithinPartitions("container")
    return dealt.mapInArrow(run, "number long, n_best long, count_sum long")


def alignment(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their counts and ``number``, the merged index, and the pairs' counts."""
    scanned = _scanned(docs, a_path, b_path)
    index = written(merged_index(scanned.filter("plane IS NOT NULL")), "pairs")
    return scanned.filter("number IS NOT NULL").select("doc_id", "number", *_TEXT_FIELDS), index, pair_counts(index)


def aligned_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``n_best`` counts links whose pair has the most links of all pairs with its B id, ties included; ``count_sum``
    adds up the pairs' corpus-wide links over the document's links. No token is empty, so a group has one link.

    A null or empty text, and one whose tokens don't give its bytes back, has no tokens: zeros and an empty
    digest column. Special tokens' strings in texts are plain text. Repeated rows, null and repeated ids are
    documents of their own; very long texts take memory for one text's tokens; further columns are ignored; an
    empty table gives no rows.
    """
    documents, index, pairs = alignment(docs, a_path, b_path)
    found = documents.join(scores(index, pairs), "number", "left")
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return found.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), *filled, "groups_sha256")
