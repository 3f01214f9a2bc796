"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all rows that the one before it kept. All but the last return the columns of
``documents``: language identification drops texts that are like no known language, near-duplicate removal keeps
one document of each component, repeated bytes are taken out of the texts, and what is left is packed
into token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import langid, packing, simhash, suffix
from ordermill.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: A text whose grams are nearly all missing from every profile is in none of the languages. Texts of the
#: languages learned score 0.35 and more. Other languages in the same script, and random letters, score above
#: the limit too and stay.
LEAST_SCORE = 0.05
#: Near copies are texts whose shingles of so many words have a Jaccard similarity of 0.8 or more.
ALIKE_WORDS = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts, texts without a letter and texts in other scripts; other languages of a known script stay."""
    docs = docs.select(*COLUMNS)
    return langid.with_a_language(docs, langid.learned_from_part(docs), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component of near fingerprints or similar texts the document with the smallest id."""
    return simhash.one_of_each(docs.select(*COLUMNS), alike_words=ALIKE_WORDS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes strings of 200 bytes that start more than once out of the texts; keeps all rows."""
    return suffix.without_repeats(docs).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts with their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("best_fit_packing", packed),
]

#: SQL can express none of the stages; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
