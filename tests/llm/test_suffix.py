import hashlib
import random
import zlib
from collections import Counter

import pytest

from ordermill.llm import suffix
from tests.llm.rows import ODD_TEXTS, documents, words

N = suffix.LENGTH


def plain_runs(raws):
    count = Counter(r[i : i + N] for r in raws for i in range(len(r) - N + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - N + 1):
            if count[r[i : i + N]] > 1:
                gone[i : i + N] = b"\1" * N
        out.append(bytes(gone))
    return out


def cases():
    r = random.Random(11)
    passage, line = words(101, 60), words(102, 25)
    texts = list(ODD_TEXTS)
    texts += [words(200 + i, 80) + passage + words(300 + i, 80) for i in range(6)]
    texts += [words(400 + i, 20) + "\n" + (line + str(i)) * 3 for i in range(4)]
    base = words(500, 500)
    for _ in range(12):
        at = r.randrange(len(base))
        texts.append(base[:at] + "#" + base[at + r.randrange(3) :])
    texts += [base[:900], base[700:1600], "ab" * 300, ("ab" * 300)[1:], "aé" * 150 + "x", "é" * 130]
    return texts


@pytest.mark.parametrize("most_kinds", [8192, 2])
def test_removal_equals_brute_force(spark, monkeypatch, most_kinds):
    monkeypatch.setattr(suffix, "repeated_starts", lambda t, f=suffix.repeated_starts: f(t, most_kinds))
    texts = cases()
    docs = documents(spark, texts, ", id long, check int, place string", (5, 6, "x")).repartition(3)
    rows = {r["doc_id"]: r for r in suffix.removal_report(docs).collect()}
    raws = [(t or "").encode() for t in texts]
    assert len(rows) == len(texts)
    for i, (raw, gone) in enumerate(zip(raws, plain_runs(raws), strict=True)):
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"]) == (len(raw), sum(gone)), i
        assert r["n_spans"] == len(gone.replace(b"\0", b" ").split()), i
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_rows_that_repeat_and_null_ids(spark):
    text = words(1, 100)
    rows = [(1, text), (1, text), (None, words(2, 90) + text[:300]), (None, None), (1, words(3, 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix.removal_report(docs).collect()
    gone = sorted((r["n_bytes"], r["n_removed"]) for r in found)
    raws = [(t or "").encode() for _, t in rows]
    assert gone == sorted((len(r), sum(g)) for r, g in zip(raws, plain_runs(raws), strict=True))
    assert suffix.removal_report(docs.limit(0)).collect() == []


def test_equal_checksums_tell_nothing(spark):
    shared, other = words(11, 80), words(12, 80)
    r = random.Random(8)
    ends = [["".join(r.choices("abcdefghijklmnop", k=n)) for _ in range(200_000)] for n in (12, 13)]
    by_sum = {zlib.crc32(e.encode(), zlib.crc32(shared.encode())): e for e in ends[0]}
    start = zlib.crc32(other.encode())
    end = next(e for e in ends[1] if zlib.crc32(e.encode(), start) in by_sum)
    texts = [shared + by_sum[zlib.crc32(end.encode(), start)], other + end]
    assert zlib.crc32(texts[0].encode()) == zlib.crc32(texts[1].encode())
    docs = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (3, shared)], "doc_id long, text string")
    gone = {r["n_bytes"]: r["n_removed"] for r in suffix.removal_report(docs).collect()}
    assert gone[len(texts[1].encode())] == 0 and gone[len(texts[0].encode())] == len(shared.encode())


def test_long_texts_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix, "_CHUNK", 700)
    texts = [words(1, 2000), words(2, 500) + words(1, 2000)[3000:5000], words(3, 900)]
    raws = [t.encode() for t in texts]
    starts = {}
    for of, at, bucket, whole, back, forth in suffix._found_anchors(raws):
        for t, a, b, f in zip(of, at, back, forth, strict=True):
            for s in range(a - b, a - f + 1):
                starts[t, s] = starts.get((t, s), 0) + 1
    assert starts == {(i, s): 1 for i, r in enumerate(raws) for s in range(len(r) - N + 1)}


def test_texts_stay_valid(spark):
    passage = "é" * 150
    texts = ["a" + passage + "b", passage + "c", None, "z" * 400, "z" * 400, words(9, 10)]
    docs = documents(spark, texts)
    rows = {r["doc_id"]: r for r in suffix.without_repeats(docs).collect()}
    assert {i: rows[i]["text"] for i in rows} == {0: "ab", 1: "c", 2: None, 3: "", 4: "", 5: words(9, 10)}
    assert rows[0]["n_chars"] == 2 and rows[2]["n_chars"] is None
    assert rows[0].asDict().keys() == set(docs.columns)
