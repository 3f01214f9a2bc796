import random
import zlib

import pytest

from ordermill.llm import shards
from tests.llm.rows import ODD_TEXTS, documents, words


def check(rows, texts, n_shards, slack):
    assert len(rows) == len(texts)
    sizes, slots, where = [0] * n_shards, {}, {}
    for r in rows:
        text = texts[r["doc_id"]]
        raw = (text or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        where.setdefault(text or "", set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes) / n_shards
    assert max(abs(s - mean) for s in sizes) <= slack
    return where


@pytest.mark.parametrize("n_shards", [1, 5, 24])
def test_shards_have_equal_bytes_and_whole_groups(spark, n_shards):
    r = random.Random(n_shards)
    texts = ODD_TEXTS + [words(i, r.randint(1, 60)) + "\n" * r.randint(0, 9) for i in range(900)]
    texts += [texts[i] for i in range(30, 60)] * 3
    docs = documents(spark, texts, ", shard string, size string", ("x", "y")).repartition(4)
    rows = shards.shard_documents(docs, n_shards, block_rows=50).collect()
    longest = max(len((t or "").encode()) for t in texts)
    where = check(rows, texts, n_shards, 2 * longest)
    assert all(len(s) == 1 for s in where.values())


def test_a_third_of_all_rows_in_one_group(spark):
    texts = [words(i, 30) for i in range(600)] + [words(-1, 30)] * 300 + [words(-2, 30)] * 20
    rows = shards.shard_documents(documents(spark, texts), 24).collect()
    where = check(rows, texts, 24, 600)
    assert len(where.pop(words(-1, 30))) > 5
    assert all(len(s) == 1 for s in where.values())


@pytest.mark.parametrize("groups", [7, 9])
def test_many_equal_groups_of_copies(spark, groups):
    texts = [words(i, 40)[:150].ljust(150, "x") for i in range(groups)] * 300
    rows = shards.shard_documents(documents(spark, texts), 24).collect()
    mean = sum(r["size"] for r in rows) / 24
    check(rows, texts, 24, 0.05 * mean)


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (1, None), (1, "b")], "doc_id long, text string")
    rows = shards.shard_documents(docs, 3).collect()
    assert len({(r["shard"], r["slot"]) for r in rows}) == 5
    assert shards.shard_documents(docs.limit(0), 24).collect() == []


def test_native_plan(spark):
    plan = shards.shard_documents(documents(spark, ["a", "b"]), 2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
