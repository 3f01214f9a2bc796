"""Small tables for the operators: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, more="", values=()):
    """Rows 0, 1, ...; ``more`` and ``values`` add columns with the same value in each row."""
    rows = [(i, t, "en", "src0", None if t is None else len(t), *values) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS + more)


def words(seed: int, n: int, of: int = 5000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(of)}é"[: r.randint(3, 7)] for _ in range(n))


ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "...", "été  ß　x", "\x1c x\x1c!", "don't 12\r\n\tstop ", "<|endoftext|> </s>", "😀" * 50,
    "aaaa" * 3000, words(1, 4000), words(2, 300), words(2, 300), "a b", "a b", "A  B", "x" * 199, "x" * 200,
]
