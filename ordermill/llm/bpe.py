"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has exactly one token that can be the last of its encoding. The table
of these tokens is filled from left to right: a token that ends at a position is the one if, behind
the last token of the prefix before it, the two would stand as they are (``fits``). Reading the table
backwards gives the encoding that merging by rank gives.

Appending bytes only extends the table; an edit changes it from the edit on until it agrees with the
old table over the length of the longest token, after which the rest is the old table.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import regex
from pyspark.sql import DataFrame

from ordermill.llm.common import UnitCache, map_texts, whole_texts


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token from a file of lines "base64 rank"."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


#: Bytes of the longest match that is remembered.
LONGEST_KNOWN = 64
#: Rank of no merge, above all ranks.
NEVER = 1 << 62


class PrefixEncoder:
    """Encoder for byte strings; holds the vocabulary and what is known about pairs of tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._width = {rank: len(token) for token, rank in ranks.items()}
        # Every end of a token: its own rank if it is a token as well, or -1.
        self._tails = {end: ranks.get(end, -1) for token in ranks for end in (token[i:] for i in range(len(token)))}
        self._histories: dict[int, tuple | None] = {}
        self._fits: dict[tuple[int, int], bool] = {}

    def history(self, token: int) -> tuple[list[int], list[bytes], list[bytes]] | None:
        """How merging by rank makes the token of its bytes: the rank of each merge, and the first and the last part
        before it. The entry behind the last merge has rank ``NEVER``. None if merging ends otherwise.
        """
        if token in self._histories:
            return self._histories[token]
        whole, ranks, tokens = self.tokens[token], self.ranks, self.tokens
        parts = [whole[i : i + 1] for i in range(len(whole))]
        made, first, last = [], [parts[0]], [parts[-1]]
        while len(parts) > 1:
            options = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not options:
                break
            rank, at = min(options)
            parts[at : at + 2] = [tokens[rank]]
            made.append(rank)
            first.append(parts[0])
            last.append(parts[-1])
        found = ([*made, NEVER], first, last) if len(parts) == 1 else None
        self._histories[token] = found
        return found

    def stands(self, token: int) -> bool:
        """Whether the token's bytes are encoded as this token alone."""
        return self.history(token) is not None

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: their bytes together are encoded as these two."""
        known = self._fits.get((left, right))
        if known is None:
            known = self._apart(left, right)
            if len(self._fits) > 1_000_000:
                self._fits.clear()
            self._fits[left, right] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge ever joins the two. Until one does, each side merges as it does alone, and the lowest
        rank of both is next, the leftmost of equal ones: so their histories are gone through side by side.
        """
        ours, theirs = self.history(left), self.history(right)
        if ours is None or theirs is None:
            return False
        (here, _, ends), (there, starts, _) = ours, theirs
        i = j = 0
        while True:
            next_left, next_right = here[i], there[j]
            across = self.ranks.get(ends[i] + starts[j], NEVER)
            if across < next_left and across <= next_right:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def extend(self, piece: bytes, last: list[int], upto: int | None = None) -> None:
        """Fills ``last``, the last token of each prefix, up to ``upto`` bytes of ``piece``."""
        fits, tails, width = self._fits, self._tails, self._width
        for end in range(len(last) + 1, (len(piece) if upto is None else upto) + 1):
            # Ends of tokens are looked up from the shortest on, until no token ends like this.
            start, found = end - 1, []
            while start >= 0:
                token = tails.get(piece[start:end])
                if token is None:
                    break
                if token >= 0:
                    found.append(token)
                start -= 1
            if not found:
                raise ValueError(f"no token of the vocabulary ends at byte {end}")
            # Exactly one of them is right, so the shortest need not be tried.
            while True:
                token = found.pop()
                if not found:
                    break
                start = end - width[token]
                if start:
                    before = last[start - 1]
                    known = fits.get((before, token))
                    if known or known is None and self.fits(before, token):
                        break
                elif self.stands(token):
                    break
            last.append(token)

    def read_back(self, last: list[int]) -> list[int]:
        ids = []
        at = len(last)
        while at:
            ids.append(last[at - 1])
            at -= len(self.tokens[ids[-1]])
        return ids[::-1]

    def encode(self, piece: bytes) -> list[int]:
        last: list[int] = []
        self.extend(piece, last)
        return self.read_back(last)

    def encode_sorted(self, pieces: list[bytes]) -> list[list[int]]:
        """Encodings of sorted pieces. Each keeps the table of what it begins with from the piece before."""
        last: list[int] = []
        before, found = b"", []
        for piece in pieces:
            shared = next((i for i, (a, b) in enumerate(zip(before, piece, strict=False)) if a != b), None)
            del last[min(len(before), len(piece)) if shared is None else shared :]
            self.extend(piece, last)
            found.append(self.read_back(last))
            before = piece
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


class PrefixTable:
    """A byte string with the last token of each of its prefixes, for appends and edits."""

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.piece, self.last = encoder, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.encoder.extend(self.piece, self.last)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Puts ``new`` for bytes ``start`` to ``end``; returns how many table entries were refilled."""
        old, shift = self.last, len(new) - (end - start)
        self.piece = self.piece[:start] + new + self.piece[end:]
        self.last = old[:start]
        same, at = 0, start
        while at < len(self.piece):
            self.encoder.extend(self.piece, self.last, at + 1)
            at += 1
            if at > start + len(new):
                same = same + 1 if self.last[-1] == old[at - 1 - shift] else 0
                if same >= self.encoder.longest:
                    self.last += old[at - shift :]
                    break
        return at - start

    def ids(self) -> list[int]:
        return self.encoder.read_back(self.last)


def text_encoder(ranks_path: str, pattern: str, most_known: int = 400_000):
    """Encoder, and function from a list of texts to a list of id lists.

    Matches of ``pattern`` are encoded apart; short ones are remembered, about ``most_known`` of them.
    """
    encoder, matches = PrefixEncoder(read_ranks(ranks_path)), regex.compile(pattern)

    known: dict[bytes, list[int]] = {}

    def encode(texts: list[str]) -> list[list[int]]:
        parts = [[m.encode("utf-8") for m in matches.findall(t)] for t in texts]
        if len(known) > most_known:
            known.clear()
        new = sorted(set().union(*parts).difference(known))
        known.update(zip(new, encoder.encode_sorted(new), strict=True))
        found = [[i for m in p for i in known[m]] for p in parts]
        for m in new:
            if len(m) > LONGEST_KNOWN:
                del known[m]
        return found

    return encoder, encode


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int), ``decoded`` (binary): the encoding of every whole text and back.

    One map over the rows, no shuffle. A null text counts as empty and gives no ids; repeated rows give
    repeated rows; an empty table gives no rows; a very long text is held once with its ids and costs time in
    proportion to its bytes; other columns are ignored.
    """

    def start():
        encoder, encode = text_encoder(ranks_path, pattern)
        cache = UnitCache(lambda parts: [(ids, encoder.decode(ids)) for ids in encode(parts)])

        def work(texts: list[str]) -> list[tuple]:
            return [
                ([i for ids, _ in found for i in ids], b"".join([raw for _, raw in found]))
                for found in cache.values(texts)
            ]

        return work

    return map_texts(whole_texts(docs), start, "ids array<int>, decoded binary")


def encoding_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """As ``encode_documents``, but digests in place of ids and bytes: small rows for comparisons.

    ``n_tokens``, ``ids_sha256`` (decimal ids joined by one space), ``decoded_sha256``, ``n_bytes``.
    """

    def start():
        encoder, encode = text_encoder(ranks_path, pattern)

        def prepared(parts: list[str]) -> list[tuple]:
            return [(" ".join(map(str, ids)).encode(), len(ids), encoder.decode(ids)) for ids in encode(parts)]

        cache = UnitCache(prepared, most=1_000_000)

        def digests(found: list[tuple]) -> tuple:
            ids, counts, parts = zip(*found, strict=True) if found else ((), (), ())
            raw = b"".join(parts)
            return sum(counts), hashlib.sha256(b" ".join(ids)).hexdigest(), hashlib.sha256(raw).hexdigest(), len(raw)

        return lambda texts: [digests(found) for found in cache.values(texts)]

    return map_texts(whole_texts(docs), start, "n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long")


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)
