import bisect
import collections
import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ordermill.llm import align
from ordermill.llm.queries import op11_token_alignment
from tests.llm.rows import ODD_TEXTS, documents, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
OUT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """Whole texts by the libraries, links by nested comparison of ends, counts in one dictionary."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    points = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(p): p for p in points} | {chr(256 + i): p for i, p in enumerate(p for p in range(256) if p not in points)}
    names = {i: t for t, i in json.load(open(A))["model"]["vocab"].items()}
    found, count = [], collections.Counter()
    for doc_id, text in rows:
        links, groups, n_a, n_b = [], [], 0, 0
        if text:
            a_ids = a.encode(" " + text, add_special_tokens=False).ids
            b_ids = b.encode(text)
            a_bytes = [bytes(letters[c] for c in names[i]) for i in a_ids]
            pieces = [b.id_to_piece(i) for i in b_ids]
            b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces)]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                n_a, n_b = len(a_ids), len(b_ids)
                a_ends, b_ends = np.cumsum([len(t) for t in a_bytes]).tolist(), np.cumsum([len(t) for t in b_bytes]).tolist()
                at = {end: j for j, end in enumerate(b_ends)}
                links = [(x, b_ids[at[end]]) for x, end in zip(a_ids, a_ends) if end in at]
                start = 0
                for end in sorted(set(a_ends) & set(b_ends)):
                    parts = [
                        ids[bisect.bisect_right(ends, start) : bisect.bisect_right(ends, end)]
                        for ids, ends in ((a_ids, a_ends), (b_ids, b_ends))
                    ]
                    groups.append("|".join(",".join(map(str, p)) for p in parts))
                    start = end
        count.update(links)
        found.append((doc_id, n_a, n_b, len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = collections.Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    for doc_id, n_a, n_b, n_groups, links, digest in found:
        best, total = sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links)
        yield doc_id, n_a, n_b, n_groups, len(links), best, total, digest


MORE = ["a \n b", "a\n  b", "a  b ", " a", "\ta\r\n", "▁", "a▁b", "<s> </s> <0x41>", "🦄 x", "a  b", "　", "a\x00b", "x" * 70, "it's 5 o'clock, l'été", "a b c"]


def check(spark, texts, slices=3):
    docs = documents(spark, texts, ", number string, plane int, a string", ("x", 1, "y")).repartition(slices)
    rows = [tuple(r) for r in align.aligned_documents(docs, A, B).select(*OUT).collect()]
    assert sorted(rows) == sorted(brute(enumerate(texts)))


def test_equals_brute_force(spark):
    check(spark, ODD_TEXTS + MORE + [words(i, 40, 50) for i in range(200)] + [words(1, 40, 50)] * 300)


def test_empty_table_and_odd_ids(spark):
    docs = documents(spark, ["a"]).filter("doc_id > 5")
    assert align.aligned_documents(docs, A, B).collect() == []
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    rows = sorted((tuple(r) for r in align.aligned_documents(docs, A, B).select(*OUT).collect()), key=str)
    assert rows == sorted(brute([(None, "a b"), (None, "a b"), (1, None)]), key=str)


@pytest.mark.parametrize("links", [5, 2000])
def test_parts_of_bitmaps_are_merged(spark, monkeypatch, links):
    monkeypatch.setattr(align, "LINKS_AT_A_TIME", links)
    check(spark, [words(i % 7, 30, 20) for i in range(150)], 1)


def test_bitmaps_keep_their_numbers():
    r = np.random.default_rng(1)
    sets = [np.sort(r.permutation(1 << 16)[:n]) for n in (1, 2, 4095, 4096, 4097, 60000)]
    keys = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    starts, bits = align.packed_bits(keys, np.concatenate(sets))
    row, lows = align.unpacked_bits(bits.to_pylist())
    assert len(starts) == len(sets) and (row == keys).all() and (lows == np.concatenate(sets)).all()
    assert [len(b) for b in bits.to_pylist()] == [2, 4, 8190, *[8192] * 3]


def test_pairs_count_documents_and_links(spark):
    docs = documents(spark, ["the the the", "the", "a", None])
    _, _, pairs = align.alignment(docs, A, B)
    counts = {(r["n_docs"], r["n_links"], r["best"]) for r in pairs.collect()}
    assert counts == {(2, 4, True), (1, 1, True)}


def test_query_equals_brute_force(spark, tiny):
    rows = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in op11_token_alignment(spark, tiny).select(*OUT).collect()]
    assert sorted(found) == sorted(brute((r[0], r[1]) for r in rows))
