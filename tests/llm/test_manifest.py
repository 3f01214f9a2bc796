import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ordermill.llm import manifest
from ordermill.llm.queries import ORACLE, op12_merkle_manifest
from tests.llm.rows import DOCUMENTS, words
from tests.oracle_check import connect, differences

OUT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute(rows):
    """Every tree as lists of levels; every proof by walking them."""

    def leaf(row, text):
        values = [row[0], row[3], row[2], row[4], text]
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, i):
        for nodes in levels[:-1]:
            yield nodes[i // 3 * 3 : i], nodes[i + 1 : i // 3 * 3 + 3]
            i //= 3

    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for members in sources.values():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = [tree([leaf(r, r[1]) for r in sources[s]]) for s in names]
    top = tree([t[-1][0] for t in trees]) if trees else []
    for at, (name, levels) in enumerate(zip(names, trees)):
        for i, row in enumerate(sources[name]):
            text, siblings = row[1], [*path(levels, i), *path(top, at)]
            if text and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            value = leaf(row, text)
            for before, after in siblings:
                value = sha(*before, value, *after)
            proof = sha(*[d for before, after in siblings for d in before + after])
            yield row[0], levels[0][i], levels[-1][0], top[-1][0], proof, value, value == top[-1][0]


def query(docs):
    def leaf(text):
        return manifest.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)

    odd = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return manifest.manifest(docs, leaf(F.col("text")), leaf(F.when(odd, F.translate("text", "\n", "")).otherwise(F.col("text"))))


def rows_of(n, sources, seed=0):
    r = random.Random(seed)
    texts = [None, "", "\n", "é\n" * 3, "a\r\nb", words(seed, 3000)]
    return [
        (r.choice([None, i, -i, 10**15 + i]), r.choice([*texts, words(i, 9)]), r.choice([None, "en"]), r.choice(sources), i % 3 or None)
        for i in range(n)
    ]


CASES = {
    "none": [],
    "one": rows_of(1, ["a"]),
    "nulls": [(None, None, None, None, None)] * 5,
    "repeated": rows_of(4, ["a"]) * 30,
    "one source each": [(i, f"\n{i}", "en", f"s{i}", 1) for i in range(200)],
    "bytewise": rows_of(60, [None, "", "é", "z", "Z", "ｚ", "😀", ""]),
    "hot": rows_of(700, ["hot"] * 9 + [f"s{i}" for i in range(30)]),
}


@pytest.mark.parametrize(
    "name, levels",
    [("none", 7), ("one", 7), ("nulls", 1), ("repeated", 1), ("one source each", 2), ("bytewise", 7), ("hot", 1), ("hot", 7)],
)
def test_equals_brute_force(spark, monkeypatch, name, levels):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", 3**levels)
    monkeypatch.setattr(manifest, "PARTITION_LEAVES", 2 * 3**levels)
    rows = CASES[name]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], DOCUMENTS + ", level int, digest string, tree long")
    found = [tuple(r) for r in query(docs).select(*OUT).collect()]
    assert sorted(found, key=str) == sorted(brute(rows), key=str)


def test_only_the_smallest_union_is_asked_for():
    for n in range(1, 60):
        for low in range(n):
            for high in range(low + 1, n + 1):
                asked = list(manifest.missing(low, high, n))
                own, needed = set(), set()
                for level, size in enumerate(manifest.levels_of(n)[:-1]):
                    for i in range(low, high):
                        at = i // 3**level
                        own.add((level, at))
                        needed |= {(level, j) for j in range(at // 3 * 3, min(at // 3 * 3 + 3, size))}
                assert len(asked) == len(set(asked)) and set(asked) == needed - own


def test_query_equals_sql(spark, tiny):
    assert differences(op12_merkle_manifest(spark, tiny), connect(tiny), ORACLE["op12_merkle_manifest"]) == []
