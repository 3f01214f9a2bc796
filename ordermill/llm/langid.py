"""Language identification by rank-order profiles of character n-grams.

A language's profile is the ranking of its most frequent one- to three-letter grams over all labelled
texts; word ends count as a letter. A text gets the language whose profile is least out of place with
the ranking of the text's own most frequent grams, where a gram that the profile lacks counts as out by
the profile's whole length.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.common import map_texts, slices, whole_texts

#: Grams in a profile, and at most in a text's ranking.
PROFILE_GRAMS = 300
UNKNOWN = "und"
_EDGE = 1  # stands for any run of characters that aren't letters
_CHARACTERS_AT_A_TIME = 1 << 19


class _Letters:
    table: np.ndarray | None = None

    @classmethod
    def of(cls, points: np.ndarray) -> np.ndarray:
        if cls.table is None:
            cls.table = np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])
        return cls.table[points]


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.zeros(0, np.int64)
    return grams[first], np.add.reduceat(counts, first) if len(first) else counts


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the grams of a whole text, sorted, and how often each occurs.

    A code holds up to three code points of 21 bits.
    """
    found = []
    lower = text.lower()
    for at in range(0, len(lower), _CHARACTERS_AT_A_TIME):
        part = lower[max(0, at - 2) : at + _CHARACTERS_AT_A_TIME]
        seen = min(at, 2)  # characters of the part before; grams that end there are counted already
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _Letters.of(points)
        points = np.where(letter, points, _EDGE).astype(np.int64)
        last = at + _CHARACTERS_AT_A_TIME >= len(lower)
        place = np.arange(len(points)) - seen
        edges = [] if at else [_EDGE]
        points = np.r_[edges, points, [_EDGE] if last else []].astype(np.int64)
        place = np.r_[[0] if not at else [], place, [len(place)] if last else []]
        once = np.r_[True, (points[1:] != _EDGE) | (points[:-1] != _EDGE)]
        points, place = points[once], place[once]
        one = points[(points != _EDGE) & (place >= 0)]
        two = (points[:-1] << 21 | points[1:])[place[1:] >= 0]
        two = two[two != (_EDGE << 21 | _EDGE)]
        three = (points[:-2] << 42 | points[1:-1] << 21 | points[2:])[(points[1:-1] != _EDGE) & (place[2:] >= 0)]
        found.append(np.unique(np.concatenate([one, two, three]), return_counts=True))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(found) == 1:
        return found[0]
    return _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))


@dataclass(frozen=True)
class Profiles:
    """Ranks of the profiles' grams: a row for each gram, a column for each language."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    most: int

    def nearest(self, text: str) -> tuple[str, float]:
        """Language and score: 1 for a text ranked as the profile is, 0 if nothing of it is in the profile."""
        grams, counts = gram_counts(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        if len(grams) > self.most:
            top = np.argsort(-counts, kind="stable")[: self.most]
            grams, counts = grams[top], counts[top]
        # Equally frequent grams share the mean of their places.
        order = np.argsort(-counts, kind="stable")
        grams, counts = grams[order], counts[order]
        first = np.flatnonzero(np.r_[True, counts[1:] != counts[:-1]])
        size = np.diff(np.r_[first, len(counts)])
        rank = np.repeat(first + (size - 1) / 2, size)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams
        place = np.where(known[:, None], self.ranks[at], -1)
        out = np.where(place < 0, self.most, np.minimum(np.abs(place - rank[:, None]), self.most)).sum(axis=0)
        best = int(np.argmin(out))
        return self.languages[best], float(1 - out[best] / (self.most * len(grams)))


def is_held_out(docs: DataFrame) -> DataFrame:
    """Adds ``held_out``: crc32 of the id as text leaves 1 when divided by 3; false without an id."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))


def learn_profiles(labelled: DataFrame, most: int = PROFILE_GRAMS) -> Profiles:
    """Profiles from ``text`` and ``lang`` of all rows that have both; other columns are ignored.

    Grams are summed within each task and then by language and gram. Only the profiles reach the driver:
    ``most`` rows for each language.
    """
    texts = labelled.select(F.col("lang").cast("string").alias("lang"), "text").filter("lang IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, (grams, counts) in sums.items():
                for at in range(0, len(grams), 100_000):
                    n = len(grams[at : at + 100_000])
                    columns = [pa.array([lang] * n), pa.array(grams[at : at + n]), pa.array(counts[at : at + n])]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

        for batch in batches:
            for part in slices(batch):
                new: dict[str, list] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                    new.setdefault(lang, []).append(gram_counts(text))
                for lang, found in new.items():
                    found += [sums[lang]] if lang in sums else []
                    sums[lang] = _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))
                if sum(len(g) for g, _ in sums.values()) > 1_000_000:
                    yield from rows()
                    sums.clear()
        yield from rows()

    counted = texts.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    rows = ranked.filter(F.col("rank") <= most).select("lang", "gram", "rank").collect()
    languages = sorted({r["lang"] for r in rows})
    grams = np.unique(np.array([r["gram"] for r in rows], np.int64))
    ranks = np.full((len(grams), len(languages)), -1, np.int32)
    column = {lang: i for i, lang in enumerate(languages)}
    for r in rows:
        ranks[np.searchsorted(grams, r["gram"]), column[r["lang"]]] = r["rank"] - 1
    return Profiles(languages, grams, ranks, most)


def identify(docs: DataFrame, profiles: Profiles, *others: str) -> DataFrame:
    """``doc_id``, ``others``, ``lang_pred``, ``score`` for every row, from its whole text alone.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was learned; a text without
    any gram of a profile gets the first language, with score 0. Repeated rows stay; ties go to the first
    language in order of names; other columns are ignored.
    """
    return map_texts(
        whole_texts(docs, *others),
        lambda: lambda texts: [profiles.nearest(t) for t in texts],
        "lang_pred string, score double",
    )


def learned_from_part(docs: DataFrame, most: int = PROFILE_GRAMS) -> Profiles:
    """Profiles from the rows that aren't held out."""
    return learn_profiles(is_held_out(docs.select("doc_id", "text", "lang")).filter(~F.col("held_out")), most)


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: learned from the part that isn't held out, for all rows."""
    found = identify(docs, learned_from_part(docs))
    return is_held_out(found).select("doc_id", "held_out", "lang_pred", "score")


def with_a_language(docs: DataFrame, profiles: Profiles, least_score: float) -> DataFrame:
    """The rows of ``docs`` whose text has a language with at least ``least_score``, unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [profiles.nearest(t or "") for t in part.column("text").to_pylist()]
                yield part.filter(pa.array([lang != UNKNOWN and score >= least_score for lang, score in found]))

    return docs.mapInArrow(run, docs.schema)
