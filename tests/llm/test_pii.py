import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from ordermill.llm import pii
from ordermill.llm.queries import op13_personal_data
from tests.llm.rows import ODD_TEXTS, documents, words

# The forms as they are stated, without what makes them fast.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, m.start(), m.end()) for k, p in FORMS.items() for m in re.finditer(p, text or "") if holds(k, m.group())]


def joined(spans):
    order = list(FORMS)
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (order.index(x[0]), *x[1:])))


def near_words(text, start, end):
    low, high = max(0, start - 100), min(len(text), end + 100)
    runs = [(m.group().lower(), low + m.start(), low + m.end()) for m in re.finditer(r"[^\W\d_]{2,}", text[low:start])]
    left = [w for w, s, _ in runs if s > low or not low][-2:]
    runs = [(m.group().lower(), end + m.end()) for m in re.finditer(r"[^\W\d_]{2,}", text[end:high])]
    right = [w for w, e in runs if e < high or high == len(text)][:2]
    return [("L", tuple(left[-n:])) for n in (1, 2) if len(left) >= n] + [("R", tuple(right[:n])) for n in (1, 2) if len(right) >= n]


def brute(texts):
    totals, held, members, occurrences = Counter(), Counter(), defaultdict(set), []
    for i, text in enumerate(t or "" for t in texts):
        runs = [m.group().lower() for m in re.finditer(r"[^\W\d_]{2,}", text)]
        totals.update((w,) for w in runs)
        totals.update(zip(runs, runs[1:]))
        base = plain(text)
        codes = [(list(FORMS).index(k), s, e) for k, s, e in base]
        for k, s, e in base + [(None, s, e) for s, e in pii.candidates(text, codes)]:
            occurrences.append((i, k, s, e, text[s:e].lower(), near_words(text, s, e)))
    places = Counter((p, o[4]) for o in occurrences for p in o[5])
    for (p, instance), n in places.items():
        held[p] += n
    rows = {(p, o[4], o[1]) for o in occurrences for p in o[5]}
    for p, instance, k in rows:
        members[p].add((instance, k))
    possible = {p for p, m in members.items() if len(m) >= 3}
    seeds = {(o[4], o[1]): 1.0 for o in occurrences if o[1] and any(p in possible for p in o[5])}
    trusted = dict(seeds)
    for _ in range(3):
        sums, support = Counter(), Counter()
        for (p, instance), n in places.items():
            for k in FORMS:
                if p in possible and (instance, k) in trusted:
                    sums[p, k] += n * trusted[instance, k]
                    support[p, k] += 1
        shares = {pk: sums[pk] / (max(held[pk[0]], totals[pk[0][1]]) + 1) for pk in sums if support[pk] >= 3}
        accepted = {pk: share for pk, share in shares.items() if share >= 0.8}
        trusted = dict(seeds)
        for p, instance in places:
            for k in FORMS:
                if (p, k) in accepted:
                    trusted[instance, k] = max(trusted.get((instance, k), 0), accepted[p, k])
    added = defaultdict(list)
    for i, k, s, e, _, near in occurrences:
        options = [(accepted[p, x], -j, x) for p in near for j, x in enumerate(FORMS) if (p, x) in accepted]
        if k is None and options:
            added[i].append((max(options)[2], s, e))
    for i, text in enumerate(texts):
        base = plain(text)
        counts = [sum(k == x for k, _, _ in base) for x in FORMS]
        yield i, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added[i]), len(added[i])


def found(docs):
    return sorted(tuple(r) for r in pii.personal_data(docs).collect())


FORMED = [
    "a@b.c@d.e x.y+z@a-b.co.uk, @a.b a@b a@.b a@b..c é@a.bc.", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 1.2.3 0.0.0.0.",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111110 5500000000000004 5 5 0 0", "+1 (487) 555-7209. +1 2 3 +12345678- ++4912345678 +1234567890123456",
    "+4" + "9" * 40 + "." * 3000, "1" * 20000, "1 " * 9000 + "2", "a@" * 500, "9." * 5000, "٣٤٥٦٧٨ ４１１１",
]


def learned(n, seed=0):
    """Local numbers and handles in the contexts of known forms, among other texts."""
    r = random.Random(seed)
    number = lambda: "".join(r.choice("0123456789") for _ in range(7))
    texts = [f"{words(i, 9)}; reach me at +49 {number()}, thanks {words(i + 1, 9)}" for i in range(n)]
    texts += [f"{words(-i, 20)} mailbox: u{i}@mail.example.com." for i in range(n)]
    texts += ["Do reach me at 555-0123, thanks a lot", "mailbox=jane.4711@intern", "the 1234567 of them, 7654321 too"]
    texts += [f"order {number()} of {words(i, 5)}" for i in range(n)] + ["order x12345@a.bc of"] * 3
    return texts


def test_equals_brute_force(spark):
    texts = ODD_TEXTS + FORMED + learned(30) + [words(i, 60) + " 12345" for i in range(40)] * 2
    docs = documents(spark, texts, ", number string, kind int, base string", ("x", 1, "y")).repartition(3)
    assert found(docs) == sorted(brute(texts))


@pytest.mark.parametrize("bits", [3, 12])
def test_full_filter_changes_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(pii, "FILTER_BITS", bits)
    texts = learned(12, 5)
    assert found(documents(spark, texts)) == sorted(brute(texts))


def test_unseen_identifiers_are_found_and_others_left_alone(spark):
    texts = learned(40)
    rows = {r[0]: r for r in found(documents(spark, texts))}
    spans = {texts[i][int(s) : int(e)]: k for i, r in rows.items() if r[7] for k, s, e in (x.split(":") for x in r[6].split(","))}
    assert spans["555-0123"] == "phone" and spans["jane.4711@intern"] == "email"
    assert "1234567" not in spans and not any(s.isdigit() and len(s) == 7 for s in spans)


def test_copies_of_one_text_teach_nothing(spark):
    texts = ["kindly ring +49 1234567890 now"] * 200 + ["kindly ring 5550123 now"]
    assert {r[7] for r in found(documents(spark, texts))} == {0}


def test_empty_table_and_odd_ids(spark):
    assert found(documents(spark, ["a"]).filter("doc_id > 5")) == []
    docs = spark.createDataFrame([(None, "a@b.cd")] * 2 + [(1, None)], "doc_id long, text string")
    rows = pii.personal_data(docs).collect()
    assert sorted((str(r["doc_id"]), r["spans"]) for r in rows) == [("1", ""), ("None", "email:0:6"), ("None", "email:0:6")]


def test_query_equals_brute_force(spark, tiny):
    rows = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    plainly = [(rows[r[0]][0], *r[1:]) for r in brute([r[1] for r in rows])]
    assert sorted(tuple(r) for r in op13_personal_data(spark, tiny).collect()) == sorted(plainly)
