import hashlib
import random

import pytest
from pyspark.sql import functions as F

from codeloom.llm import chat
from tests.llm.support import duck_rows, plain_rows

COLUMNS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
NASTY = [
    "", "plain", "<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "<|", "<", "|>", "\\", "a\nb\n", "<|im_start|",
    "<<|im_end|>", "é<|im_end|>ß\U0001f600", "<|im_end|><|im_start|>assistant ok", "x" * 100_000 + "<|im_end|>", "<\\", "\n", "$1 \\1",
]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def read_back(text):
    """An independent reader of the format."""
    turns = []
    for chunk in text.split("<|im_start|>")[1:]:
        assert chunk.endswith("<|im_end|>\n")
        role, body = chunk.removesuffix("<|im_end|>\n").split("\n", 1)
        assert "<|im_end|>" not in body
        role = role.replace("\\p", "|").replace("\\n", "\n").replace("\\b", "\\")
        out, i = "", 0
        while i < len(body):
            j = i + 1
            while body[i] == "<" and body[j:j + 1] == "\\":
                j += 1
            if body[i] == "<" and j > i + 1 and body[j:j + 1] == "|":
                out, i = out + "<" + "\\" * (j - i - 2) + "|", j + 1
            else:
                out, i = out + body[i], i + 1
        turns.append((role, out))
    return turns


def test_every_text_comes_back(spark):
    rng = random.Random(1)
    parts = ["<", "|", "\\", "im_end", "im_start", ">", "\n", "a", "assistant"]
    texts = NASTY + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    roles = ["user", "assistant", "system", "", "odd\nrole", "<|im_end|>", "a\\nb", "\\", "assistant<|", "\\p\\b"]
    rows = [(i // 3, i % 3, roles[(i * 7) % len(roles)], t) for i, t in enumerate(texts)]
    made = {r.conv_id: r for r in chat.format_conversations(conversations(spark, rows)).collect()}
    for conv in {r[0] for r in rows}:
        source = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert made[conv].identical and read_back(made[conv].formatted) == source
        spans = [made[conv].formatted[s.begin:s.end] for s in made[conv].loss_spans]
        wanted = [t for r, t in source if r == "assistant"]
        assert [read_back(f"<|im_start|>r\n{s}<|im_end|>\n")[0][1] for s in spans] == wanted


def test_plain_text_is_not_escaped(spark):
    made = chat.format_conversations(conversations(spark, [(1, 0, "user", "a < b | c \\ d")])).first()
    assert made.formatted == "<|im_start|>user\na < b | c \\ d<|im_end|>\n" and made.n_escaped == 0


def test_digests_of_awkward_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, None, None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (None, None, "user", "x"), (2, None, "user", "")]
    found = {r[0]: r for r in plain_rows(chat.digests(chat.format_conversations(conversations(spark, rows).withColumn("formatted", F.lit(1)))), *COLUMNS)}
    turns = "\n\nassistant\na\nassistant\nb\nassistant\nb\n"
    assert found[1][1:5] == (4, hashlib.sha256(turns.encode()).hexdigest(), 3, hashlib.sha256(b"abb").hexdigest())
    assert found[None][1] == 1 and found[2][3:5] == (0, hashlib.sha256(b"").hexdigest())
    assert chat.digests(chat.format_conversations(conversations(spark, []))).collect() == []


def test_query_against_sql(spark, sf):
    found = plain_rows(chat.query(spark, sf), *COLUMNS)
    assert found == duck_rows(chat.SQL, sf, list(COLUMNS)) and any(r[0] == -1 and r[1] == 2 for r in found)


@pytest.mark.parametrize("word", ["Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"])
def test_no_python_in_the_plan(spark, sf, word):
    assert word not in chat.query(spark, sf)._jdf.queryExecution().executedPlan().toString()
