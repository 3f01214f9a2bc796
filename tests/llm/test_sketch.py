import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ordermill.llm import sketch
from tests.llm.rows import ODD_TEXTS, documents, words


def plain_likeness(a, b):
    x, y = Counter(sketch.paragraphs(a)), Counter(sketch.paragraphs(b))
    both = x.total() + y.total()
    return 1 - ((x - y).total() + (y - x).total()) / both if both else 1.0


@pytest.mark.parametrize("ranges", [1, 7, 200])
def test_rows_equal_brute_force(spark, ranges):
    r = random.Random(ranges)
    texts = ODD_TEXTS + [". ".join(words(r.randrange(40), r.randint(1, 20)) for _ in range(r.randint(1, 30))) for _ in range(60)]
    texts += [texts[-1]] * 3
    docs = documents(spark, texts, ", fingerprint int, place string, id long", (1, "x", 2)).repartition(3)
    rows = {x["doc_id"]: x for x in sketch.fingerprints(docs, ranges).collect()}
    assert len(rows) == len(texts)
    same = {}
    for i, text in enumerate(texts):
        text, following = text or "", texts[i - 1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(plain_likeness(text, edited))
        assert row["near_next"] == pytest.approx(plain_likeness(text, following))
        same.setdefault(text, set()).add(row["fingerprint"])
        assert row["edited_fingerprint"] == sketch.Document.of(edited).table.text()
    assert all(len(s) == 1 for s in same.values())


def test_tables_give_back_every_difference():
    r = np.random.default_rng(4)
    for n in (0, 1, 5, 50, 3000):
        a, b, both = (r.integers(0, 2**63, k).astype(np.uint64) for k in (n, n // 2, 400))
        x, y = np.r_[a, both], np.r_[both, b]
        assert sketch.differences(x, y, sketch.Table.of(x), sketch.Table.of(y)) == n + n // 2
        assert sketch.Table.of(x).size() == n + 400


def test_null_and_repeated_ids(spark):
    rows = [(None, "a. b"), (None, "c"), (3, "x y"), (3, "x y"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sketch.fingerprints(docs, 3).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["3", "3", "3", "None", "None"]
    assert sorted(r["n_chars"] for r in found) == [0, 1, 3, 3, 4]
    one = sketch.fingerprints(docs.filter("doc_id IS NULL AND text = 'c'")).collect()
    assert [(r["near_edited"], r["near_next"]) for r in one] == [(1.0, 1.0)]
    assert sketch.fingerprints(docs.limit(0)).collect() == []
