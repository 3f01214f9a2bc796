import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordermill.llm import langid
from tests.llm.rows import ODD_TEXTS, documents


def plain_grams(text):
    """Grams of letters with word ends as a letter."""
    s = "\1" + "".join(c if c.isalpha() else "\1" for c in text.lower()) + "\1"
    while "\1\1" in s:
        s = s.replace("\1\1", "\1")
    grams = [s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)]
    return Counter(g for g in grams if g != "\1" and "\1" not in g[1:-1] and g != "\1\1")


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


@pytest.mark.parametrize("at_a_time", [7, 1 << 19])
def test_grams_of_whole_texts(monkeypatch, at_a_time):
    monkeypatch.setattr(langid, "_CHARACTERS_AT_A_TIME", at_a_time)
    for text in ODD_TEXTS:
        grams, counts = langid.gram_counts(text or "")
        plain = {code(g): n for g, n in plain_grams(text or "").items()} if (text or "").strip() else {}
        assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == plain, text and text[:30]


def plain_nearest(text, profiles, most):
    top = sorted(plain_grams(text).items(), key=lambda x: (-x[1], code(x[0])))[:most]
    rank = {g: sum(i for i, (_, m) in enumerate(top) if m == n) / sum(m == n for _, m in top) for g, n in top}
    out = {
        lang: sum(min(most, abs(ranks[g] - r)) if g in ranks else most for g, r in rank.items())
        for lang, ranks in profiles.items()
    }
    best = min(out, key=lambda lang: (out[lang], lang))
    return best, 1 - out[best] / (most * len(rank))


def test_predictions_equal_brute_force(spark):
    r = random.Random(2)
    letters = {"aa": "abcde", "bb": "efghi", "cc": "klmé"}
    rows = []
    for i in range(120):
        lang = r.choice(sorted(letters))
        text = " ".join("".join(r.choices(letters[lang], k=r.randint(1, 6))) for _ in range(r.randint(1, 40)))
        rows.append((i, text, None if i % 17 == 0 else lang, "s", 1, 0.5))
    rows += [(200 + i, t, None, "s", 1, 0.5) for i, t in enumerate(ODD_TEXTS)] + [(None, "abc", "aa", "s", 1, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    most = 40
    sums = {}
    for i, text, lang, *_ in rows:
        if lang is not None and text is not None and (i is None or zlib.crc32(str(i).encode()) % 3 != 1):
            sums.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {
        lang: {g: k for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:most])}
        for lang, c in sums.items()
    }
    found = langid.identify(docs, langid.learned_from_part(docs, most))
    found = {r["doc_id"]: r for r in langid.is_held_out(found).collect()}
    assert len(found) == len(rows)
    for i, text, *_ in rows:
        assert found[i]["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
        if not any(c.isalpha() for c in text or ""):
            assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
        else:
            lang, score = plain_nearest(text, profiles, most)
            assert found[i]["score"] == pytest.approx(score)
            assert found[i]["lang_pred"] == lang


def test_nothing_learned_and_empty_table(spark):
    docs = documents(spark, ["abc"]).withColumn("lang", F.lit(None).cast("string"))
    assert [r["lang_pred"] for r in langid.identified(docs).collect()] == ["und"]
    assert langid.identified(docs.limit(0)).collect() == []


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = langid.identified(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
