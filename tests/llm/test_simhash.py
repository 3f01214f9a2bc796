import random
import re

import numpy as np
import pytest
import xxhash

from ordermill.llm import simhash
from tests.llm.rows import ODD_TEXTS, documents, words


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lower)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes):
    """By doc: the smallest doc reachable."""
    root = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_fingerprints_and_components(spark):
    texts = ODD_TEXTS + [words(9, 400) + f" tail{i}" for i in range(12)] + [words(i, 5) for i in range(40)]
    docs = documents(spark, texts, ", fp string, root int, key long", ("x", 3, 4)).repartition(3)
    codes = [plain_fingerprint(t) for t in texts]
    rows = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    assert {i: r["fingerprint"] for i, r in rows.items()} == {i: f"{c:016x}" for i, c in enumerate(codes)}
    assert [rows[i]["component_id"] for i in range(len(texts))] == plain_components(codes)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = words(4, 3000)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_BYTES_AT_A_TIME", 100)
    assert simhash.fingerprint(text) % 2**64 == whole % 2**64 == plain_fingerprint(text)


@pytest.mark.parametrize("most", [4096, 30])
def test_links_of_random_codes_equal_brute_force(spark, most):
    r = random.Random(most)
    codes = set()
    for _ in range(150):
        base = r.getrandbits(64)
        codes |= {base ^ sum({1 << r.randrange(64) for _ in range(r.randint(0, 4))}) for _ in range(3)}
    # Codes that share most of their bits, so that groups have to be cut.
    codes |= {(7 << 40) ^ sum({1 << r.randrange(12) for _ in range(6)}) for _ in range(200)}
    codes = sorted(codes)
    df = spark.createDataFrame([(c - 2**64 if c >> 63 else c,) for c in codes], "fp long")
    found = {r["node"] % 2**64: r["root"] % 2**64 for r in simhash.fingerprint_components(df, most).collect()}
    groups = {}
    for c in codes:
        groups.setdefault(found.get(c, c), set()).add(c)
    plain = {}
    for c, root in zip(codes, plain_components(codes), strict=True):
        plain.setdefault(root, set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_index_finds_all_near_pairs():
    r = np.random.default_rng(1)
    codes = r.integers(0, 2**9, 300).astype(np.uint64) << np.uint64(30)
    codes = np.unique(codes)
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    codes = codes[np.argsort(rank)]
    i, j = simhash.GrayIndex(codes).near(0, len(codes), 2)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 2
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {tuple(p) for p in np.argwhere(np.triu(near, 1)).tolist()}


def test_one_of_each_group_stays(spark):
    docs = documents(spark, ODD_TEXTS)
    kept = {r["doc_id"] for r in simhash.one_of_each(docs).collect()}
    assert kept == set(plain_components([plain_fingerprint(t) for t in ODD_TEXTS]))
    assert simhash.one_of_each(documents(spark, [])).collect() == []
