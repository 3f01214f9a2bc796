import textwrap

import duckdb
import pytest

from ordermill.llm import licenses
from ordermill.llm.license_texts import NOTICES, TEXTS
from tests.llm.rows import ODD_TEXTS, documents

MIT = "The MIT License (MIT)\n\nCopyright (c) 2020 Jane Doe\nAll rights reserved.\n\n" + TEXTS["MIT"].replace("sublicense", "sub-license")
CASES = [
    (MIT, "MIT", "proprietary", 1),
    (MIT.upper().replace("\n", "\r\n\t"), "MIT", None, None),
    (TEXTS["ISC"].replace(",", " , "), "ISC", "", 0),
    (TEXTS["MIT"] + " More.", None, "", 0),
    ("a\nReleased under the MIT Licence!\nb\n  licensed under the APACHE license version 2.0\nReleased under the MIT license", None, "Apache-2.0,MIT", 3),
    ("This is not released under the MIT License.", None, "", 0),
    ("All rights reserved.", None, "proprietary", 1),
]


def test_known_cases(spark):
    docs = documents(spark, [c[0] for c in CASES], ", license string, notices int, named string", ("x", 1, "y"))
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    for i, (_, license_, notices, lines) in enumerate(CASES):
        if i != 1:
            assert (rows[i]["license"], rows[i]["notices"], rows[i]["notice_lines"]) == (license_, notices, lines), i


def test_every_known_licence_and_notice_is_found(spark):
    docs = documents(spark, [*TEXTS.values(), *NOTICES])
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert [rows[i]["license"] for i in range(len(TEXTS))] == list(TEXTS)
    assert [rows[len(TEXTS) + i]["notices"] for i in range(len(NOTICES))] == list(NOTICES.values())


@pytest.mark.parametrize("copies", [0, 1, 2])
def test_equals_sql(spark, copies):
    docs = documents(spark, (ODD_TEXTS + [c[0] for c in CASES] + list(TEXTS.values())) * copies)
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"text": object}).where(lambda d: d.notna(), None))
    names = ["doc_id", "license", "text_digest", "notices", "notice_lines"]
    plain = con.execute(f"SELECT {', '.join(names)} FROM ({licenses.oracle_sql()})").fetchall()
    found = [tuple(r) for r in licenses.scan(docs).select(*names).collect()]
    assert sorted(map(str, found)) == sorted(map(str, plain))


HEADS = ["", "Copyright (c) 2020 Jane Doe\n\n", "ISC License\n\nCopyright 2019, 2021 The Copyright Holders\n(c) Acme, Inc. All rights reserved.\n\n", "© 2020 Doe "]


@pytest.mark.parametrize("width", [None, 20, 40, 60, 72, 79, 100])
def test_wrapping_does_not_matter(spark, width):
    whole = [(name, head + t) for head in HEADS for name, t in TEXTS.items()]
    wrapped = [" ".join(t.split()) if width is None else textwrap.fill(" ".join(t.split()), width) for _, t in whole]
    paragraphs = ["\n\n".join(" ".join(p.split()) for p in t.split("\n\n")) for _, t in whole]
    rows = {r["doc_id"]: r["license"] for r in licenses.scan(documents(spark, wrapped + paragraphs)).collect()}
    assert [rows[i] for i in range(len(rows))] == [name for name, _ in whole] * 2


def test_other_words_are_no_head(spark):
    mit = TEXTS["MIT"]
    texts = ["Some words. " + mit, "Copyright 2020 Doe. " + "These are terms of another kind. " * 20 + mit, mit + " More.", mit.replace("copyright notice", "notice")]
    assert {r["license"] for r in licenses.scan(documents(spark, texts)).collect()} == {None}


def test_texts_of_other_kinds(spark):
    texts = {"Deed": "This licence lets you share the work.\nYou must give credit.", "Zero": "No rights are kept (c) in this work."}
    docs = documents(spark, ["Copyright 2020 Doe\n\n" + texts["Deed"].replace("licence", "license"), texts["Zero"].upper(), texts["Zero"] + " x"])
    assert {r["doc_id"]: r["license"] for r in licenses.scan(docs, texts).collect()} == {0: "Deed", 1: "Zero", 2: None}


def test_native_plan(spark):
    plan = licenses.scan(documents(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan
