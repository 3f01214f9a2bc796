import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ordermill.llm import packing
from ordermill.llm.common import UnitCache
from tests.llm.rows import ODD_TEXTS, documents, words

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_every_piece_has_its_place(spark, library, capacity):
    texts = ODD_TEXTS + [words(i, i) for i in range(60)]
    docs = documents(spark, texts, ", piece int, rank string", (7, "x")).repartition(5)
    rows = packing.pack_documents(docs, TOKENIZER, capacity=capacity).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert len(by_doc) == len(texts)
    total = 0
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        total += len(ids)
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(math.ceil(len(ids) / capacity)))
        assert sum(p["length"] for p in pieces) == len(ids)
        assert all(p["length"] == capacity for p in pieces[1:])
        for p in pieces:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == p["ids_crc32"]
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) <= math.ceil(total / capacity) + 2


def test_units_are_encoded_as_by_the_library(library):
    r = random.Random(4)
    letters = ["a", "b", " ", "  ", "\n", "\r\n", "\t", "é", "!", "'s", "12", "\x1c", "\x85", "\xa0", "😀", "the", "<|endoftext|>"]
    texts = ["".join(r.choices(letters, k=r.randint(0, 30))) for _ in range(3000)]
    cache = UnitCache(packing.joined_encoder(TOKENIZER), most=500)
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        for text, found in zip(some, cache.values(some), strict=True):
            ids = np.frombuffer(b"".join(found), "<u4").tolist()
            assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_strings_of_added_tokens_are_those_tokens(spark):
    texts = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> \n<|endoftext|><|endoftext|>x", "a  <|endoftext|>  b c"]
    rows = packing.token_pieces(documents(spark, texts), TOKENIZER, 2, 1024).collect()
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() if isinstance(r["ids"], (bytes, bytearray)) else r["ids"] for r in rows}
    assert ids[0] == [64, 50256, 65, 2] and ids[1] == [50256, 2]
    plain = Tokenizer.from_file(TOKENIZER)
    assert all(ids[i] == [*plain.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts))


def test_fullest_is_the_best_sum():
    r = random.Random(5)
    for _ in range(200):
        counts = {r.randint(1, 40): r.randint(1, 3) for _ in range(r.randint(1, 6))}
        chosen = packing.fullest(counts, 40)
        assert all(chosen[n] <= counts[n] for n in chosen) and max(counts) in chosen
        sums = {0}
        for n, c in counts.items():
            c -= n == max(counts)
            sums = {s + n * k for s in sums for k in range(c + 1)}
        best = max(s for s in sums if s + max(counts) <= 40) + max(counts)
        assert sum(n * k for n, k in chosen.items()) == best


def test_plan_is_short_and_tight_for_many_pieces():
    r = random.Random(6)
    counts = {n: r.randint(0, 100_000) for n in range(1, 1025)}
    rows = packing.plan(counts, 1024)
    sequences = sum(n * c for n, c in counts.items()) / 1024
    assert len(rows) < 20_000
    assert rows[:, 2].max() < sequences * 1.005 + 2


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), TOKENIZER).collect() == []
