"""Personal data by patterns, and by contexts that are learned from what the patterns find.

Four kinds are found by their form alone. These seeds stand in contexts: the one or two words before, and after.
Each context is a pattern; patterns and the things they surround (instances) make a graph. Round by round, a
pattern is as good as the share of its words' occurrences that surround trusted instances, and an instance as good
as the best of its accepted patterns. Accepted patterns then mark things of no known form that look like
identifiers. Words count wherever they occur, so a pattern of common words is never accepted.

Graph and scores are tables; texts are read twice, once for seeds and candidates and once to count words.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import slices, stored, whole_texts, written

KINDS = ["email", "ip", "card", "phone"]

#: A pattern is accepted with so many different trusted instances and this share of its words' occurrences
#: (one more is assumed, that isn't an instance).
LEAST_INSTANCES = 3
LEAST_SHARE = 0.8
ROUNDS = 3
#: Characters on either side in which context words are looked for, and digits of an identifier.
NEAR = 100
LEAST_DIGITS = 4
#: Bits of the filter that tells which word counts are wanted. Its size is fixed; a full filter counts all words.
FILTER_BITS = 24

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that fails at a run's first digit fails at its other digits too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

_WORD = re.compile(r"[^\W\d_]{2,}")
_NUMBERS = r"[0-9(+][0-9()+./-]*+(?:\x20[0-9(][0-9()./-]*+)*+"
_CANDIDATE = re.compile(rf"""(?<![^\s=:"'<>|,;])(?:{_NUMBERS}(?![^\s=:"'<>|,;!?])|[^\s=:"'<>|,;]*?[0-9@][^\s=:"'<>|,;]*+)""")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what has the form of a kind, in order."""
    found = []
    if "@" in text:
        before = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > before and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append((0, start, m.end()))
                before = m.end()
    if not _DIGITS.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.findall(m.group())) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def candidates(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Starts and ends of things that look like identifiers and touch none of ``spans``."""
    if "@" not in text and not _DIGITS.search(text):
        return
    taken = sorted((s, e) for _, s, e in spans)
    starts, reach = [s for s, _ in taken], np.maximum.accumulate([e for _, e in taken]).tolist()
    for m in _CANDIDATE.finditer(text):
        whole = m.group()
        start = m.start() + next((i for i, c in enumerate(whole) if c.isalnum()), len(whole))
        end = m.end() - next((i for i, c in enumerate(reversed(whole)) if c.isalnum()), 0)
        if end - start < LEAST_DIGITS or len(_DIGITS.findall(text, start, end)) < LEAST_DIGITS and "@" not in text[start:end]:
            continue
        at = bisect_left(starts, end)
        if not at or reach[at - 1] <= start:
            yield start, end


def hashed(word: str) -> int:
    """A 64-bit number, never 0, for a word in any case."""
    return (xxhash.xxh64_intdigest(word.lower().encode("utf-8")) | 1) - (1 << 63)


def _pair(first, second):
    """A number for two words in order; works on arrays too."""
    return (first * np.int64(-7046029254386353131)) ^ (second >> np.int64(3)) ^ (second << np.int64(7)) | np.int64(1)


def contexts(text: str, start: int, end: int) -> tuple[int, int, int, int]:
    """Numbers of the word before, the two words before, the word after, the two after; 0 where there are none."""
    low, high = max(0, start - NEAR), min(len(text), end + NEAR)
    # A word that goes on beyond the stretch looked at is no context.
    left = [m.group() for m in _WORD.finditer(text, low, start) if m.start() > low or low == 0][-2:]
    right = [m.group() for m in _WORD.finditer(text, end, high) if m.end() < high or high == len(text)][:2]
    a, b = np.array([hashed(w) for w in left], np.int64), np.array([hashed(w) for w in right], np.int64)
    with np.errstate(over="ignore"):
        return (
            int(a[-1]) if len(a) else 0,
            int(_pair(a[0], a[1])) if len(a) == 2 else 0,
            int(b[0]) if len(b) else 0,
            int(_pair(b[0], b[1])) if len(b) == 2 else 0,
        )


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


_COUNTS = [f"n_{k}" for k in KINDS]
_SPAN = "struct<kind:int,start:int,stop:int>"


def _scanned(texts: DataFrame) -> DataFrame:
    """Two kinds of rows, written once: documents (``base`` not null), and seeds and candidates with their contexts."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
    names = ["doc_id", "number", *_COUNTS, "base_sha256", "base", "kind", "start", "stop", "instance", "keys"]
    types = [pa.int64()] * 5 + [pa.string(), pa.list_(span)] + [pa.int32()] * 3 + [pa.int64(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc_rows, things = [], []
                for number, text in zip(part.column("number").to_pylist(), part.column("text").to_pylist(), strict=True):
                    spans = base_spans(text)
                    counts = [sum(k == i for k, _, _ in spans) for i in range(4)]
                    digest = hashlib.sha256(joined(spans).encode("ascii")).hexdigest()
                    base = [{"kind": k, "start": s, "stop": e} for k, s, e in spans]
                    doc_rows.append((number, *counts, digest, base, None, None, None, None, None))
                    for k, s, e in [*spans, *((-1, s, e) for s, e in candidates(text, spans))]:
                        instance = xxhash.xxh64_intdigest(text[s:e].lower().encode("utf-8")) - (1 << 63)
                        things.append((number, *[None] * 6, k, s, e, instance, list(contexts(text, s, e))))
                for rows, ids in ((doc_rows, part.column("doc_id")), (things, pa.nulls(len(things), part.schema.field("doc_id").type))):
                    if rows:
                        values = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)]
                        yield pa.RecordBatch.from_arrays([ids, *values], names=names)

    fields = ", ".join(f"{c} long" for c in ["number", *_COUNTS])
    fields += f", base_sha256 string, base array<{_SPAN}>, kind int, start int, stop int, instance long, keys array<long>"
    return written(texts.mapInArrow(run, f"doc_id {kind}, {fields}"), "personal")


def _word_counts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``key`` and how often its word or pair of words occurs in all texts, for the ``key`` of ``wanted`` at least."""
    slot = F.col("key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bitmaps = wanted.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    # At most 2 ** FILTER_BITS bits, however many patterns there are.
    rows = bitmaps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    bits = np.zeros((1 << FILTER_BITS) // 8 + 2 * 4096, np.uint8)
    for row in rows:
        held = np.frombuffer(row["bits"], np.uint8)
        bits[(row["bucket"] - 1) * 4096 + 4096 :][: len(held)] = held
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = shared.value, {}
        found: list[np.ndarray] = []
        held = 0

        def asked(keys: np.ndarray) -> np.ndarray:
            # Numbering of the aggregate: bucket 1 holds 1 to 32768, bucket 0 holds 0.
            at = keys & np.int64((1 << FILTER_BITS) - 1)
            at = np.where(at > 0, at - 1 + 32768, 0)
            return keys[bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]

        def summed() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts.astype(np.int64))], names=["key", "times"])

        for batch in batches:
            for part in slices(batch):
                texts_words = [_WORD.findall(t) for t in part.column("text").to_pylist()]
                if len(known) > 500_000:
                    known.clear()
                known.update((w, hashed(w)) for w in set().union(*texts_words).difference(known))
                sizes = np.array([len(w) for w in texts_words], np.int64)
                keys = np.fromiter((known[w] for words in texts_words for w in words), np.int64, int(sizes.sum()))
                # The last word of a text and the first of the next are no pair.
                within = np.ones(max(len(keys) - 1, 0), bool)
                ends = np.cumsum(sizes)[:-1]
                within[ends[(ends > 0) & (ends < len(keys))] - 1] = False
                with np.errstate(over="ignore"):
                    both = _pair(keys[:-1], keys[1:])[within]
                found += [asked(keys), asked(both)]
                held += len(found[-1]) + len(found[-2])
                if held > 2_000_000:
                    yield summed()
                    found, held = [], 0
        if held:
            yield summed()

    counted = texts.select("text").mapInArrow(run, "key long, times long")
    return counted.groupBy("key").agg(F.sum("times").alias("times"))


def pattern_graph(texts: DataFrame, things: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (``slot``, ``key``, ``instance``, ``kind``, ``times``) of patterns that may be accepted, and what they occur.

    ``slot`` tells which context it is. Only patterns with ``LEAST_INSTANCES`` different instances are kept.
    """
    pattern = ["slot", "key"]
    every = things.select("instance", "kind", F.posexplode("keys").alias(*pattern)).filter("key <> 0")
    edges = stored(every.groupBy(*pattern, "instance", "kind").agg(F.count(F.lit(1)).alias("times")))
    patterns = edges.groupBy(*pattern).agg(F.count(F.lit(1)).alias("instances"), F.sum("times").alias("held"))
    patterns = stored(patterns.filter(F.col("instances") >= LEAST_INSTANCES).drop("instances"))
    counted = _word_counts(texts, patterns)
    totals = patterns.join(counted, "key", "left").select(*pattern, F.greatest("held", F.coalesce("times", F.lit(0))).alias("total"))
    return stored(edges.join(patterns.select(*pattern), pattern)), stored(totals)


def accepted_patterns(edges: DataFrame, totals: DataFrame) -> DataFrame:
    """``slot``, ``key``, ``kind``, ``share``, ``instances`` of the patterns accepted after ``ROUNDS`` rounds."""
    pattern = ["slot", "key"]
    seeds = edges.filter("kind >= 0").select("instance", "kind").distinct().withColumn("trust", F.lit(1.0))
    places = edges.groupBy(*pattern, "instance").agg(F.sum("times").alias("times"))
    places = places.join(totals, pattern)
    trusted, accepted = seeds, None
    for _ in range(ROUNDS):
        sums = places.join(trusted, "instance").groupBy(*pattern, "kind", "total")
        rated = sums.agg(F.sum(F.col("times") * F.col("trust")).alias("in"), F.count(F.lit(1)).alias("instances"))
        share = (F.col("in") / (F.col("total") + 1)).alias("share")
        rated = rated.select(*pattern, "kind", share, "instances")
        accepted = stored(rated.filter((F.col("share") >= LEAST_SHARE) & (F.col("instances") >= LEAST_INSTANCES)))
        met = places.select(*pattern, "instance").join(accepted, pattern)
        learned = met.groupBy("instance", "kind").agg(F.max("share").alias("trust"))
        trusted = seeds.unionByName(learned).groupBy("instance", "kind").agg(F.max("trust").alias("trust"))
    return accepted


def personal_data(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text: what has the form of a kind, and what accepted contexts surround.

    ``doc_id``; ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` and ``base_sha256`` of the spans found by form;
    ``spans``, all spans as ``kind:start:stop`` in code points, by kind and place; ``n_added`` spans found by context.
    Where several accepted patterns surround a thing, the one with the largest share names the kind (of equals
    the kind that is listed first).

    A null text counts as empty and holds nothing; repeated rows, null and repeated ids are documents of their own,
    but repeats of an instance count once towards a pattern's instances. Very long texts are read whole. Further
    columns are ignored; an empty table gives no rows.
    """
    texts = whole_texts(docs).withColumn("number", F.monotonically_increasing_id())
    scanned = _scanned(texts)
    things = scanned.filter("base IS NULL").select("number", "kind", "start", "stop", "instance", "keys")
    accepted = accepted_patterns(*pattern_graph(texts, things))
    unknown = things.filter("kind < 0").select("number", "start", "stop", F.posexplode("keys").alias("slot", "key"))
    met = unknown.filter("key <> 0").join(accepted, ["slot", "key"])
    best = F.max_by("kind", F.struct("share", -F.col("kind"))).alias("kind")
    added = met.groupBy("number", "start", "stop").agg(best).groupBy("number")
    added = added.agg(F.collect_list(F.struct("kind", "start", "stop")).alias("added"))
    found = scanned.filter("base IS NOT NULL").join(added, "number", "left")
    more = F.coalesce("added", F.expr(f"cast(array() as array<{_SPAN}>)"))
    names = F.array(*[F.lit(k) for k in KINDS])
    described = F.transform(
        F.array_sort(F.concat("base", more)),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")),
    )
    spans = F.concat_ws(",", described).alias("spans")
    return found.select("doc_id", *_COUNTS, "base_sha256", spans, F.size(more).cast("long").alias("n_added"))
