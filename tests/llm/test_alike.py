import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ordermill.llm import alike, simhash
from tests.llm.rows import ODD_TEXTS, documents, words
from tests.llm.test_simhash import plain_fingerprint


def plain_shingles(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def plain_kept(texts):
    sets, codes = [plain_shingles(t) for t in texts], [plain_fingerprint(t) for t in texts]
    root = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if (codes[i] ^ codes[j]).bit_count() <= 2 or x | y and 5 * len(x & y) >= 4 * len(x | y):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return sorted(set(root))


def edited(text, edits, seed):
    r, found = random.Random(seed), text.split()
    for _ in range(edits):
        found[r.randrange(len(found))] = f"new{r.randrange(10**6)}"
    return " ".join(found)


def test_near_copies_with_ordinary_edits_go(spark):
    passage = words(70, 80)
    texts = [words(900 + i, 12) for i in range(30)]
    texts += [words(i, 30) + " " + passage for i in range(30)]  # share a passage, but not most shingles
    for i in range(12):
        base = words(200 + i, 150)
        texts += [edited(base, e, 10 * i + e) for e in range(8)]
    chain = words(500, 200)
    for i in range(6):
        texts.append(chain := edited(chain, 4, i))
    texts += [words(600, 300), words(600, 300) + " end"]
    docs = documents(spark, texts).repartition(3)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == plain_kept(texts)
    assert len(kept) < len(simhash.one_of_each(docs).collect())


def test_odd_texts(spark):
    texts = ODD_TEXTS + ["a b c d", "a  B c\nd", "a b c d e", "A b c d e "]
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(documents(spark, texts), alike_words=5).collect())
    same = [" ".join((t or "").encode().lower().decode().split(" ")) for t in texts]
    assert kept and len(kept) <= len(set(same))
    assert kept == sorted(set(kept)) and simhash.one_of_each(documents(spark, []), alike_words=5).collect() == []


def linked(spark, texts, ids=None):
    """Components of texts by the links alone."""
    rows = list(zip(ids or range(len(texts)), texts))
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "id long, text string, root int, sketch int").repartition(4)
    roots = df.select("id", F.col("id").alias("root")).distinct()
    root = {i: i for i, _ in rows}
    for u, v in alike.links(df, roots, 5).collect():
        a, b = sorted((root[u], root[v]))
        root = {k: a if r == b else r for k, r in root.items()}
    return root


def plainly_linked(texts):
    sets, root = [plain_shingles(t) for t in texts], list(range(len(texts)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x | y and 5 * len(x & y) >= 4 * len(x | y):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return dict(enumerate(root))


def templates(n, changed, seed=0):
    """Texts of one form, each with its own words in some places."""
    r = random.Random(seed)
    form = words(77, 400).split()
    texts = []
    for _ in range(n):
        text = list(form)
        for i in r.sample(range(len(form)), changed):
            text[i] = f"own{r.randrange(10**9)}"
        texts.append(" ".join(text))
    return texts


@pytest.mark.parametrize("block", [2048, 7])
def test_texts_of_one_form_that_all_meet(spark, monkeypatch, block):
    monkeypatch.setattr(alike, "BLOCK", block)
    texts = templates(60, 9) + templates(40, 3, 1) + [words(i, 300) for i in range(20)]
    assert linked(spark, texts) == plainly_linked(texts)


def test_texts_of_one_form_below_the_similarity_are_no_pairs(spark):
    texts = templates(300, 10)
    met = alike._meetings(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), 5)
    pairs = alike._pairs(alike._in_blocks(met.withColumn("root", F.col("id")), True), True)
    assert pairs.count() < 5 * len(texts)


def test_repeated_rows_nulls_and_short_texts(spark):
    texts = [words(1, 200), words(1, 200), None, "", "a b", "A  b", "a b c", words(2, 2000), words(2, 2000) + " end"]
    ids = [0, 0, 2, 3, 4, 5, 6, 7, 8]
    root = linked(spark, texts, ids)
    assert (root[5], root[8]) == (4, 7) and len(set(root.values())) == 6
    assert linked(spark, texts[:1]) == {0: 0}


def test_sketches_never_differ_in_more_than_the_sets():
    r = np.random.default_rng(3)
    for n in (5, 255, 256, 257, 900, 40_000):
        x = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.append(x[n // 9 :], r.integers(0, 1 << 63, n // 5).astype(np.uint64)))
        sizes = np.array([len(x), len(y)])
        near = alike.are_alike(x, y)
        both = [alike.sketch(x), alike.sketch(y)]
        allowed = alike._allowed(sizes, both, np.array([0]), np.array([1]))[0, 0]
        assert allowed or not near
        wide = [np.frombuffer(s, np.uint8)[None, :] for s in both]
        width = min(w.shape[1] for w in wide)
        a, b = (alike._folded(w, width) for w in wide)
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))


def test_clashing_columns_and_null_ids(spark):
    rows = [(None, words(5, 90)), (None, words(5, 90) + " x"), (4, words(6, 90)), (4, words(6, 90))]
    docs = spark.createDataFrame([(*r, 7, 8, "z") for r in rows], "doc_id long, text string, id int, value int, root string")
    kept = simhash.one_of_each(docs, alike_words=5).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["4", "None"]
    assert kept[0].asDict().keys() == set(docs.columns)


def test_first_rounds_put_out_a_pair_a_text_and_meeting(spark, monkeypatch):
    monkeypatch.setattr(alike, "BLOCK", 16)
    texts = templates(200, 2)
    met = alike._meetings(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), 5)
    dealt = alike._in_blocks(met.withColumn("root", F.col("id")), False)
    assert dealt.count() == met.count()
    assert alike._pairs(dealt, False).count() <= alike.MEETINGS * len(texts)
    assert set(linked(spark, texts).values()) == {0}


def test_texts_near_the_similarity_give_no_square_of_pairs(spark):
    texts = templates(300, 5)  # most pairs are just below, too near for sketches to tell
    met = alike._meetings(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), 5)
    pairs = alike._pairs(alike._in_blocks(met.withColumn("root", F.col("id")), True), True)
    assert pairs.count() <= alike.MEETINGS * len(texts)


@pytest.mark.parametrize("shingles", [1 << 20, 5000])
def test_chains_of_texts_near_the_similarity(spark, monkeypatch, shingles):
    monkeypatch.setattr(alike, "BLOCK_SHINGLES", shingles, raising=False)
    texts = templates(60, 5) + templates(40, 6, 1) + templates(40, 7, 2)
    assert 1 < len(set(linked(spark, texts).values())) < len(texts)
    assert linked(spark, texts) == plainly_linked(texts)
