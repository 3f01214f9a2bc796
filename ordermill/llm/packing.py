"""Packing of documents into token sequences by minimum bin slack.

Only a document longer than a sequence is cut: into full pieces and a first piece with what is left
over. Full pieces fill a sequence each, so what is to be packed is known from one number for each
length below the capacity: how many pieces have it. From these counts, at most ``capacity`` of them
whatever the input, the plan is made: take the longest piece left, find by subset sums over the
lengths left (a bit set of reachable sums) the fullest combination with it, and use the same
combination as often as the counts allow. Each step uses up a length or leaves fewer of it than one
sequence takes, so the plan is short. Pieces then take their places in it by length and rank.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordermill.llm.common import UnitCache, environment_for_tokenizers, slices, stored, whole_texts


#: Fixed value: the pattern of byte-level tokenizers.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _ids_of(tokenizer_path: str, added: bool = True):
    """Bytes of each id (or None), and a function from texts to id arrays; nothing is put around a text.

    A string of an added token (``<|endoftext|>``) in a text becomes that token, as in the library, unless
    ``added`` is false: then it is plain text. Where the file ranks its merges in the order of their ids, as
    byte-level vocabularies do, its vocabulary goes to the rank-based library, which gives the same ids several
    times faster.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        described = json.load(file)
    model, before = described["model"], described.get("pre_tokenizer") or {}
    vocabulary = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in merges]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
    tokens = {t["content"]: t["id"] for t in described["added_tokens"]}
    # Tokens that reach beyond their own characters are left to the library.
    plain = plain and not any(t[f] for t in described["added_tokens"] for f in ("lstrip", "rstrip", "single_word"))
    if plain and not described.get("normalizer") and all(a < b for a, b in zip(made, made[1:], strict=False)):
        points = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in points}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in points)}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in tokens}
        special = tokens if added else {}
        library = tiktoken.Encoding(tokenizer_path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        lengths = {i: len(t) for t, i in ranks.items()} | {i: len(t.encode("utf-8")) for t, i in special.items()}
        width = np.zeros(max(lengths) + 1, np.int64)
        width[list(lengths)] = list(lengths.values())

        def encoded(text: str) -> list[int]:
            if any(t in text for t in special):
                return library.encode(text, allowed_special="all", disallowed_special=())
            return library.encode_ordinary(text)

        return width, lambda texts: [np.array(encoded(t), "<u4") for t in texts]

    environment_for_tokenizers()
    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.encode_special_tokens = not added
    return None, lambda texts: [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def joined_encoder(tokenizer_path: str):
    """Function from sorted text units to their ids as little-endian 32-bit numbers.

    Units that end in a character other than white space are encoded in one text, since the tokenizer
    starts anew at the white space between them; lengths in bytes tell where each unit's ids end.
    """
    width, ids = _ids_of(tokenizer_path)

    def encode(parts: list[str]) -> list[bytes]:
        out: dict[int, bytes] = {}
        joined = [] if width is None else [i for i, u in enumerate(parts) if not u[-1].isspace() and u[0] not in "\x1c\x1d\x1e\x1f"]
        for at in range(0, len(joined), 4096):
            some = joined[at : at + 4096]
            # A line feed keeps a unit that starts without white space apart; it is one token of one byte.
            texts = [u if u[0].isspace() else "\n" + u for u in (parts[i] for i in some)]
            found = ids(["".join(texts)])[0]
            ends = np.cumsum([len(t.encode("utf-8")) for t in texts])
            cuts = np.searchsorted(np.cumsum(width[found]), ends) + 1
            start = 0
            for i, text, cut in zip(some, texts, cuts.tolist(), strict=True):
                out[i] = found[start + (len(text) != len(parts[i])) : cut].tobytes()
                start = cut
        others = [i for i in range(len(parts)) if i not in out]
        out |= {i: x.tobytes() for i, x in zip(others, ids([parts[i] for i in others]), strict=True)}
        return [out[i] for i in range(len(parts))]

    return encode


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of all documents: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids``.

    A document's ids are those of its text and ``end_id``. A null text counts as empty: one piece.
    """
    return _pieces(docs, tokenizer_path, end_id, capacity, True).drop("task", "rank")


def _pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, with_ids: bool) -> DataFrame:
    """Also where a piece stands: its task, and its rank among the task's pieces of the same length."""
    texts = whole_texts(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = UnitCache(joined_encoder(tokenizer_path))
        tail = np.array([end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for part in slices(batch):
                of, rows = [], []
                for i, found in enumerate(cache.values(part.column("text").to_pylist())):
                    raw = b"".join([*found, tail])
                    total = len(raw) // 4
                    for piece, start in enumerate([0, *range(total % capacity or capacity, total, capacity)]):
                        end = total % capacity or capacity if piece == 0 else start + capacity
                        ids = raw[4 * start : 4 * end]
                        rank = seen[end - start]
                        seen[end - start] += 1
                        of.append(i)
                        rows.append((piece, start, end - start, zlib.crc32(ids), task, rank, ids))
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                arrays = [part.column("doc_id").take(pa.array(of, pa.int32()))]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                arrays += [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in columns[6]]))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long"
    return texts.mapInArrow(run, fields + (", ids array<int>" if with_ids else ""))


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The longest length left and, with it, what fills ``capacity`` best: how many of each length."""
    longest = max(counts)
    room = capacity - longest
    steps: list[tuple[int, int, int]] = []  # sums reachable before, length, how many at once
    reach, mask = 1, (1 << room + 1) - 1
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, many = min(counts[length] - (length == longest), room // length), 1
        while left and not reach >> room & 1:
            many = min(many, left)
            steps.append((reach, length, many))
            reach |= reach << length * many & mask
            left, many = left - many, many * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {longest: 1}
    for before, length, many in reversed(steps):
        if not before >> total & 1:
            total -= length * many
            chosen[length] = chosen.get(length, 0) + many
    return chosen


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces in a sequence, offset of the first), in order.

    Pieces of a length take sequences by rank, so many in each, until the next row of the length.
    """
    left = {n: c for n, c in counts.items() if c}
    taken = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        chosen = fullest(left, capacity)
        times = min(left[n] // k for n, k in chosen.items())
        for (n, k), offset in zip(chosen.items(), accumulate((n * k for n, k in chosen.items()), initial=0)):  # noqa: B905
            rows.append((n, taken[n], sequence, k, offset))
            taken[n] += k * times
            left[n] -= k * times
            if not left[n]:
                del left[n]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(pieces: DataFrame, rows: np.ndarray) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` by ``length`` and ``place``. The plan's size is bounded."""
    kind = pieces.drop("place").schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            length, place = (batch.column(c).to_numpy() for c in ("length", "place"))
            row = rows[np.searchsorted(keys, length << 48 | place, side="right") - 1]
            nth = place - row[:, 1]
            more = [pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)]
            kept = batch.drop_columns(["place"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *more], names=[*kept.schema.names, "sequence_id", "offset"])

    return pieces.mapInArrow(run, kind + ", sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024, with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Null texts count as empty (one piece, the end id alone); repeated rows are packed each; an empty
    table gives no rows; other columns are ignored. ``with_ids`` adds the ids of each piece.
    """
    pieces = stored(_pieces(docs, tokenizer_path, end_id, capacity, with_ids))
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    firsts = by_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["length", "task"]).withColumn("place", F.col("first") + F.col("rank"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "place"]
    return _placed(ranked.select(*columns), plan(counts, capacity))
