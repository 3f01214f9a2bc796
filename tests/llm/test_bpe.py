import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from ordermill.llm import bpe
from tests.llm.rows import ODD_TEXTS, documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.text_encoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder[0].ranks, special_tokens={}
    )


def test_documents_are_encoded_as_by_the_library(spark, library):
    docs = documents(spark, ODD_TEXTS + ODD_TEXTS[:3], ", n_tokens int, ids string", (7, "x"))
    rows = {r["doc_id"]: r for r in bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).collect()}
    digests = {r["doc_id"]: r for r in bpe.encoding_digests(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert len(rows) == len(digests) == len(ODD_TEXTS) + 3
    for i, text in enumerate(ODD_TEXTS + ODD_TEXTS[:3]):
        ids = library.encode_ordinary(text or "")
        assert list(rows[i]["ids"]) == ids
        assert bytes(rows[i]["decoded"]).decode() == (text or "")
        assert digests[i]["n_tokens"] == len(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def merged(ranks, piece):
    """Merging by rank as it is defined: the lowest pair, the leftmost of equal ones, until no pair is a token."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        options = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not options:
            return [ranks[p] for p in parts]
        _, at = min(options)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_neighbours_fit_if_merging_leaves_them(encoder):
    own, r = encoder[0], random.Random(5)
    for _ in range(4000):
        left, right = r.randrange(50_000), r.randrange(50_000)
        assert own.fits(left, right) == (merged(own.ranks, own.tokens[left] + own.tokens[right]) == [left, right])
    # Parts of words, which merge across more often.
    words = [t for t in own.tokens.values() if t.isalpha() and len(t) > 2]
    for word in r.sample(words, 3000):
        at = r.randrange(1, len(word))
        left, right = own.ranks.get(word[:at]), own.ranks.get(word[at:])
        if left is not None and right is not None:
            assert own.fits(left, right) == (merged(own.ranks, word) == [left, right])


@pytest.mark.parametrize("seed", range(6))
def test_neighbours_fit_under_ranks_of_any_order(seed):
    r = random.Random(seed)
    tokens = {bytes([b]) for b in b"abc"} | {bytes(r.choices(b"abc", k=r.randint(2, 5))) for _ in range(60)}
    order = sorted(tokens)
    r.shuffle(order)
    own = bpe.PrefixEncoder({t: i for i, t in enumerate(order)})
    for left in range(len(order)):
        assert own.stands(left) == (merged(own.ranks, own.tokens[left]) == [left])
        for right in range(len(order)):
            assert own.fits(left, right) == (merged(own.ranks, own.tokens[left] + own.tokens[right]) == [left, right])


def test_megabytes_without_white_space(encoder, library):
    r = random.Random(9)
    text = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    assert encoder[1]([text]) == [library.encode_ordinary(text)]


def test_empty_table(spark):
    assert bpe.encoding_digests(documents(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


def test_appends_and_edits_equal_a_fresh_encoding(encoder):
    r = random.Random(3)
    letters = [b"the", b"ing", b"a", b"b", b" ", b"\xc3\xa9", b"tion", b"z"]
    for _ in range(40):
        t = bpe.PrefixTable(encoder[0], b"".join(r.choices(letters, k=30)))
        for _ in range(10):
            new = b"".join(r.choices(letters, k=r.randint(0, 5)))
            if r.random() < 0.3:
                t.append(new)
            else:
                start = r.randint(0, len(t.piece))
                t.replace(start, min(len(t.piece), start + r.randint(0, 6)), new)
            assert t.ids() == encoder[0].encode(t.piece)


def test_an_edit_refills_only_what_is_near(encoder):
    t = bpe.PrefixTable(encoder[0], b"the winding road and another thing " * 200)
    before = len(t.piece)
    refilled = t.replace(100, 103, b"xyz")
    assert refilled < 2 * encoder[0].longest + 200 < before
    assert t.ids() == encoder[0].encode(t.piece)
