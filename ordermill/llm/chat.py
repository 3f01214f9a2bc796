"""Chat formatting, assembled from tokens.

A turn becomes ``<|turn|>`` role ``<|text|>`` text ``<|end|>``. Role and text are encoded on their own, as
ordinary text, and spliced between ids reserved for the three marks; so no text can ever produce a mark,
whatever it says. In the text form a mark is only a string, so control strings inside roles and texts are
escaped: a backslash goes behind their first character, one more than stands there already, and reading
takes one away. Where loss applies follows from prefix sums over the lengths of the spliced parts.

The encoding is one map over the turns. Conversations are then read as a stream sorted by turn, so that
no conversation is held as a whole, however long.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.bpe import read_ranks
from ordermill.llm.common import slices

MARKS = ("<|turn|>", "<|text|>", "<|end|>")
# Control strings of public chat templates, escaped as well.
FOREIGN = ("<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"

# No control string ends as another begins, so occurrences never overlap.
_CONTROL = re.compile("|".join(rf"(?<={re.escape(c[0])})\\*(?={re.escape(c[1:])})" for c in MARKS + FOREIGN))
_ESCAPED = re.compile("|".join(rf"(?<={re.escape(c[0])})\\(?=\\*{re.escape(c[1:])})" for c in MARKS + FOREIGN))


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    # Of several backslashes only the first has the control string's first character before it.
    return _ESCAPED.sub("", text)


class Template:
    """Encoder and reader of turns; reserved ids follow the vocabulary's and its end-of-text id."""

    def __init__(self, ranks_path: str, pattern: str):
        ranks = read_ranks(ranks_path)
        self.library = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        first = max(ranks.values()) + 2
        self.turn, self.text, self.end = first, first + 1, first + 2

    def assemble(self, roles: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all turns, where each turn ends in them, and where loss begins and ends within each turn."""
        roles_ids = [self.library.encode_ordinary(escape(r)) for r in roles]
        texts_ids = [self.library.encode_ordinary(escape(t)) for t in texts]
        lengths = np.ones((len(roles), 5), np.int64)
        lengths[:, 1] = [len(i) for i in roles_ids]
        lengths[:, 3] = [len(i) for i in texts_ids]
        ends = np.cumsum(lengths).reshape(-1, 5)
        ids = np.empty(ends[-1, -1] if len(ends) else 0, np.int32)
        for column, mark in ((0, self.turn), (2, self.text), (4, self.end)):
            ids[ends[:, column] - 1] = mark
        for column, parts in ((1, roles_ids), (3, texts_ids)):
            for part, end in zip(parts, ends[:, column], strict=True):
                ids[end - len(part) : end] = part
        begin = ends[:, 4] - lengths.sum(axis=1)
        has_loss = np.array([r == LOSS_ROLE for r in roles], bool)
        loss_from = ends[:, 2] - begin
        return ids, ends[:, 4], loss_from, np.where(has_loss, ends[:, 3] - begin, loss_from)

    def decode(self, ids: np.ndarray) -> str:
        """Text form of ids, marks included."""
        marks = dict(zip((self.turn, self.text, self.end), MARKS, strict=True))
        cuts = np.flatnonzero(ids >= self.turn).tolist()
        out, at = [], 0
        for cut in [*cuts, len(ids)]:
            out.append(self.library.decode_bytes(ids[at:cut].tolist()).decode("utf-8"))
            if cut < len(ids):
                out.append(marks[int(ids[cut])])
            at = cut + 1
        return "".join(out)

    def read(self, formatted: str) -> tuple[str, str]:
        """Role and text of a turn in text form."""
        role, text = formatted.removeprefix(MARKS[0]).removesuffix(MARKS[2]).split(MARKS[1])
        return unescape(role), unescape(text)


def format_turns(conversations: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per row ``conv_id``, ``turn``, ``role``, ``ids``, ``loss_from``, ``loss_to`` (places in ``ids`` under the loss).

    A null role or text counts as empty; only the assistant's texts are under the loss; repeated rows are
    turns of their own; other columns are ignored.
    """
    blank = F.lit("")
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")
    )
    kinds = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(ranks_path, pattern)
        for batch in batches:
            for part in slices(batch):
                roles, texts = part.column("role").to_pylist(), part.column("text").to_pylist()
                ids, ends, loss_from, loss_to = template.assemble(roles, texts)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids))
                columns = [part.column("conv_id"), part.column("turn"), part.column("role"), lists]
                columns += [pa.array(loss_from, pa.int32()), pa.array(loss_to, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["conv_id", "turn", "role", "ids", "loss_from", "loss_to"]
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, ids array<int>, loss_from int, loss_to int"
    return turns.mapInArrow(run, schema)


class _Digest:
    """What is read back from a conversation's formatted turns, taken in order."""

    def __init__(self) -> None:
        self.turns = self.loss_chars = self.formatted_chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, template: Template, ids: np.ndarray, loss_from: int, loss_to: int) -> None:
        formatted = template.decode(ids)
        role, text = template.read(formatted)
        under = unescape(template.decode(ids[loss_from:loss_to]))
        self.turns += 1
        self.formatted_chars += len(formatted)
        self.loss_chars += len(under)
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(under.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(formatted: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per conversation, read from its formatted turns in order of ``turn`` (ties: role, then ids).

    ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``. A null ``turn`` comes
    first; rows with a null ``conv_id`` are one conversation. A digest can only be computed in order, so
    a conversation is one task's stream; its memory is a batch, not the conversation.
    """
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, current, digest = Template(ranks_path, pattern), None, None
        for batch in batches:
            of = batch.column("conv_id").to_pylist()
            ids = batch.column("ids")
            values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
            spans = [batch.column(c).to_pylist() for c in ("loss_from", "loss_to")]
            done = []
            for i, conv in enumerate(of):
                if digest is None or conv != current:
                    if digest is not None:
                        done.append((current, *digest.row()))
                    current, digest = conv, _Digest()
                digest.add(template, values[offsets[i] : offsets[i + 1]], spans[0][i], spans[1][i])
            yield rows(done, batch.schema.field("conv_id").type)
        if digest is not None:
            yield rows([(current, *digest.row())], batch.schema.field("conv_id").type)

    def rows(done: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * 6
        types = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    fields = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return dealt.mapInArrow(run, f"conv_id {kind}, {fields}")


def digests(conversations: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    return read_back(format_turns(conversations, ranks_path, pattern), ranks_path, pattern)
