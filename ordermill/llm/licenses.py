"""License scans by canonical digest lookup.

Texts are brought to a canonical form: lower case, one space for any punctuation or white space, one
spelling for equivalent ones. What is compared is the text from the first words of a known licence on, if
only a title and copyright statements stand before them, so that it doesn't matter where lines end; or else
the text without copyright and title lines. Its digest is joined to the digests of known licences; the
digests of single lines are looked up among known notices.
Only built-in functions are used, and rows are never shuffled: what is joined is a fixed list.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.license_texts import NOTICES, SPELLINGS, TEXTS, TITLES

_COPYRIGHT_LINES = r"(?im)^[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©)[^\n]*$"
_RESERVED_LINES = r"(?im)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
_TITLE_LINE = r"(?i)^[^\p{L}\p{N}]*(?:" + "|".join(t.replace("(", r"\(").replace(")", r"\)") for t in TITLES) + r")[^\p{L}\p{N}\n]*\n"

_BETWEEN = r"[^\p{L}\p{N}]+"
_TITLE = rf"(?i)^[^\p{{L}}\p{{N}}]*(?:{'|'.join(_BETWEEN.join(re.findall(r'[^\W_]+', t)) for t in sorted(TITLES, key=len, reverse=True))})(?![\p{{L}}\p{{N}}])"
_STATEMENT = r"copyright|\(c\)|©"
_STATEMENTS_ONLY = rf"(?i)^[^\p{{L}}\p{{N}}]*(?:\z|{_STATEMENT}|all{_BETWEEN}rights{_BETWEEN}reserved)"
#: Words that tell a licence's beginning, and words of a copyright statement at most.
_LEAD_WORDS = 4
_STATEMENT_WORDS = 40

#: Every known notice has one of these in it, so other lines need no canonical form.
NOTICE_WORDS = r"(?i)licen[sc]e|reserved"
#: The same for whole texts.
TEXT_WORD = "software"


def canonical(text: Column) -> Column:
    """Lower case, words with single spaces, one spelling. A text without a word becomes empty."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    for other, spelling in SPELLINGS.items():
        words = F.regexp_replace(words, rf"\b{other}\b", spelling)
    return words


def canonical_text(text: Column) -> Column:
    """Canonical form of a whole licence text, without title and copyright lines."""
    for pattern in (_TITLE_LINE, _COPYRIGHT_LINES, _RESERVED_LINES):
        text = F.regexp_replace(text, pattern, "\n")
    return canonical(text)


def _leads(texts: dict[str, str]) -> str:
    """Pattern of the words that the known texts begin with."""

    def spelled(word: str) -> str:
        known = SPELLINGS.get(word.lower(), word.lower())
        return "|".join([known, *(other.replace(" ", _BETWEEN) for other, x in SPELLINGS.items() if x == known)])

    leads = {_BETWEEN.join(f"(?:{spelled(w)})" for w in re.findall(r"[^\W_]+", t)[:_LEAD_WORDS]) for t in texts.values()}
    return rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(sorted(leads - {''}))})(?![\p{{L}}\p{{N}}])"


def canonical_body(text: Column, texts: dict[str, str]) -> Column:
    """Canonical form of a text, however its lines are wrapped, without title and copyright statements at its head."""
    head = F.regexp_extract(text, rf"(?is)^(.*?)(?={_leads(texts)})", 1)
    said = F.regexp_replace(head, _TITLE, "")
    words = F.regexp_count(said, F.lit(r"[\p{L}\p{N}]+"))
    statements = F.regexp_count(said, F.lit(rf"(?i){_STATEMENT}|reserved"))
    only_said = said.rlike(_STATEMENTS_ONLY) & (words <= statements * _STATEMENT_WORDS)
    return canonical(F.when(only_said, F.substring(text, F.char_length(head) + 1, F.char_length(text))).otherwise(text))


def known_bodies(spark, texts: dict[str, str] = TEXTS) -> DataFrame:
    """``known_body``, ``body_license``: one row for each licence known, a fixed list."""
    rows = spark.createDataFrame(list(texts.items()), "body_license string, known string")
    return rows.select(F.sha2(canonical_body(F.col("known"), texts), 256).alias("known_body"), "body_license")


def known_texts(spark, texts: dict[str, str] = TEXTS) -> DataFrame:
    """``known_digest``, ``license``: one row for each licence known, a fixed list."""
    rows = spark.createDataFrame(list(texts.items()), "license string, known string")
    return rows.select(F.sha2(canonical_text(F.col("known")), 256).alias("known_digest"), "license")


def scan(docs: DataFrame, texts: dict[str, str] = TEXTS, notices: dict[str, str] = NOTICES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``license`` and ``text_digest`` of the whole text, ``notices``, ``notice_lines``.

    ``license`` is that of which the whole text is a copy, however wrapped, else null; ``text_digest`` is that of
    the text without copyright lines, so it depends on the wrapping, and null for texts that can't be a copy. ``notices`` are the distinct licences that single lines name, in order of name, joined by
    commas (empty if none), and ``notice_lines`` the number of such lines. A null text counts as empty;
    repeated rows stay; an empty table gives no rows; other columns are ignored. Word lists follow the
    defaults: texts have a ``text_digest`` if they hold ``TEXT_WORD``, and notices must match ``NOTICE_WORDS``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    of_notice = F.create_map(*[x for n, name in notices.items() for x in (F.sha2(canonical(F.lit(n)), 256), F.lit(name))])
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOTICE_WORDS))
    named = F.array_compact(F.transform(lines, lambda line: F.try_element_at(of_notice, F.sha2(canonical(line), 256))))
    rows = docs.select(
        "doc_id",
        F.when(F.lower(text).contains(TEXT_WORD), F.sha2(canonical_text(text), 256)).alias("text_digest"),
        F.when(text.rlike(rf"(?i){_leads(texts)}"), F.sha2(canonical_body(text, texts), 256)).alias("body_digest"),
        named.alias("named"),
    )
    # The lists of known licences are constants of a few rows.
    known = F.broadcast(known_texts(docs.sparkSession, texts))
    bodies = F.broadcast(known_bodies(docs.sparkSession, texts))
    found = rows.join(known, rows["text_digest"] == known["known_digest"], "left")
    found = found.join(bodies, rows["body_digest"] == bodies["known_body"], "left")
    return found.select(
        "doc_id",
        F.coalesce("body_license", "license").alias("license"),
        "text_digest",
        F.array_join(F.array_sort(F.array_distinct("named")), ",").alias("notices"),
        F.size("named").cast("long").alias("notice_lines"),
    )


def _sql_canonical(text: str) -> str:
    words = rf"trim(regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    for other, spelling in SPELLINGS.items():
        words = rf"regexp_replace({words}, '\b{other}\b', '{spelling}', 'g')"
    return words


def oracle_sql() -> str:
    """The scan as DuckDB SQL over ``documents``."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    whole = "coalesce(text, '')"
    for pattern in (_TITLE_LINE, _COPYRIGHT_LINES, _RESERVED_LINES):
        whole = f"regexp_replace({whole}, {quoted(pattern)}, chr(10), 'g')"
    texts = ", ".join(f"({quoted(t)}, {quoted(name)})" for name, t in TEXTS.items())
    notices = ", ".join(f"({quoted(t)}, {quoted(name)})" for t, name in NOTICES.items())
    known_whole = whole.replace("coalesce(text, '')", "known")
    return f"""
    WITH texts AS (SELECT sha256({_sql_canonical(known_whole)}) AS digest, license FROM (VALUES {texts}) t(known, license)),
    notice AS (SELECT sha256({_sql_canonical("known")}) AS digest, name FROM (VALUES {notices}) t(known, name)),
    docs AS (
        SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text,
            CASE WHEN contains(lower(text), '{TEXT_WORD}') THEN sha256({_sql_canonical(whole)}) END AS text_digest
        FROM documents
    ),
    lines AS (
        SELECT n, sha256({_sql_canonical("line")}) AS digest
        FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM docs)
        WHERE regexp_matches(line, {quoted(NOTICE_WORDS)})
    ),
    named AS (
        SELECT n, string_agg(DISTINCT name, ',' ORDER BY name) AS notices, count(*) AS notice_lines
        FROM lines JOIN notice USING (digest) GROUP BY n
    )
    SELECT doc_id, license, text_digest, coalesce(notices, '') AS notices, coalesce(notice_lines, 0) AS notice_lines
    FROM docs LEFT JOIN texts ON text_digest = digest LEFT JOIN named USING (n)
    """
