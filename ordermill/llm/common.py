"""Helpers shared by the operators: whole texts in tasks, stored intermediate tables, text units."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ordermill.session import cut_lineage, ensure_checkpoint_dir

#: Bytes of a text batch that are turned into Python objects at a time, but one text at least.
SLICE_BYTES = 4 << 20

_UNIT = re.compile(r"\s*\S+|\s+")
# White space to Python, but not to the tokenizers' pattern.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Written once to the shared checkpoint folder: lost executors cost nothing that is stored."""
    return cut_lineage(df)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read again."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir()
    path = f"{folder}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return spark.read.parquet(path)


def whole_texts(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id``, ``text`` (null becomes empty) and ``others``; further columns are left behind."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *others)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about ``most`` bytes of ``text`` each."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def map_texts(texts: DataFrame, start: Callable[[], Callable[[list[str]], list[tuple]]], fields: str) -> DataFrame:
    """One output row per row of ``texts``: its other columns, and ``fields`` computed from its text.

    ``start()`` runs once per task and returns the function from some texts to the values of ``fields``
    for each of them. Memory holds one Arrow batch and a slice of it as objects.
    """
    kept = [c for c in texts.columns if c != "text"]
    schema = texts.select(*kept).schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", " + fields
    added = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in slices(batch):
                found = work(part.column("text").to_pylist())
                values = [pa.array(v, t) for v, t in zip(zip(*found, strict=True), added.types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *values], names=kept + added.names)

    return texts.select(*kept, "text").mapInArrow(run, schema)


def units(text: str) -> list[str]:
    """Parts of a text that the byte-level tokenizers encode independently of each other.

    Their pattern starts a new match at each white-space character that follows another character,
    so a text may be cut there. A unit is white space and the characters up to the next white space.
    """
    return [text] if _ODD_SPACE.search(text) else _UNIT.findall(text)


class UnitCache:
    """What ``encode`` makes of text units, remembered for units seen before in this task.

    ``encode`` gets a sorted list of distinct units and returns a list of values. At most ``most`` short
    units are remembered: half of them from before the last change of generation, and of those only
    the ones met again pass on. Results don't depend on what is remembered. ``cut`` makes units of a text.
    """

    def __init__(self, encode: Callable[[list[str]], list], most: int = 600_000, longest: int = 64, cut=units):
        self.encode, self.most, self.longest, self.cut = encode, most, longest, cut
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}

    def values(self, texts: list[str]) -> list[list]:
        """For each text the values of its units, in order. Unknown units of all texts go to ``encode`` at once."""
        parts = [self.cut(t) for t in texts]
        if len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        unknown = set().union(*parts).difference(known)
        known.update((u, older[u]) for u in unknown.intersection(older))
        missing = sorted(unknown.difference(known))
        if missing:
            known.update(zip(missing, self.encode(missing), strict=True))
        values = [list(map(known.__getitem__, p)) for p in parts]
        for u in missing:
            if len(u) > self.longest:
                del known[u]
        return values


def environment_for_tokenizers() -> None:
    """One thread per task: Spark already runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
