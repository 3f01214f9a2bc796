import hashlib
import random

import public_tokenizers
import pytest

from ordermill.llm import chat

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ROWS = "conv_id long, turn long, role string, text string, ids string"


@pytest.fixture(scope="module")
def template():
    return chat.Template(RANKS, public_tokenizers.PATTERN)


def odd_texts(n):
    r = random.Random(8)
    parts = [*chat.MARKS, *chat.FOREIGN, "<\\|end|>", "<\\\\|end|>", "\\", "<", "|end|>", "[", "\\[INST]", " ok ", "é😀", "\n", "/s>"]
    return ["".join(r.choices(parts, k=r.randint(0, 8))) for _ in range(n)]


def test_escaping_is_reversible_and_leaves_no_control_string():
    for text in odd_texts(3000):
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.MARKS + chat.FOREIGN)


def test_assembly_reads_back(template):
    texts = odd_texts(200)
    roles = [["user", "assistant", "", "<|end|>"][i % 4] for i in range(200)]
    ids, ends, loss_from, loss_to = template.assemble(roles, texts)
    start = 0
    for role, text, end, a, z in zip(roles, texts, ends, loss_from, loss_to, strict=True):
        turn = ids[start:end]
        assert template.read(template.decode(turn)) == (role, text)
        assert chat.unescape(template.decode(turn[a:z])) == (text if role == "assistant" else "")
        start = end


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        chars = sum(len(chat.escape(r[2] or "")) + len(chat.escape(r[3] or "")) + len("".join(chat.MARKS)) for r in turns)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
        out[conv] = (len(turns), sha[0], len(loss), sha[1], chars)
    return out


def test_digests_equal_brute_force(spark):
    texts = odd_texts(300)
    rows = [(i % 7 if i % 11 else None, i, ["system", "user", "assistant"][i % 3], t, "x") for i, t in enumerate(texts)]
    rows += [(-7, i, r, "</s>[INST] ok [/INST]", "x") for i, r in enumerate(("user", "assistant"))]
    rows += [(8, None, "user", "a", "x"), (8, 1, None, None, "x"), (8, 2, "assistant", None, "x"), (9, 1, "user", "same", "x")]
    rows += [(9, 1, "user", "same", "x"), (10, 0, "assistant", "long " * 50_000, "x")]
    random.Random(1).shuffle(rows)
    found = chat.digests(spark.createDataFrame(rows, ROWS).repartition(5), RANKS, public_tokenizers.PATTERN).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in found} == plain(rows)


def test_empty_table(spark):
    assert chat.digests(spark.createDataFrame([], ROWS), RANKS, public_tokenizers.PATTERN).collect() == []
