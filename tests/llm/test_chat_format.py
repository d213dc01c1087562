import hashlib
import re

import pytest
from pyspark.sql import functions as F

from txguard.llm import chat_format
from txguard.llm.chat_format import digests, escape, examples, loss_text, turns_of, unescape

TURNS = [
    (1, 0, "system", "be brief"),
    (1, 1, "user", "hi </s> [INST] x [/INST]"),
    (1, 2, "assistant", r"<\s> <\\/s> [\INST] \[NAME] <s><s>"),
    (1, 3, "user", ""),
    (1, 4, "assistant", " ends with a space "),
    (1, 5, "user", None),
    (2, 1, "user", "no reply\n[/TURN]"),
    (3, 0, "assistant", ""),
    (3, 0, "assistant", ""),
    (4, None, "tool [NAME] </s>", "42 [/TURN]\n"),
    (4, 0, None, "[TURN] a [NAME] b"),
    (4, 1, "assistant", "grün 日本 \U0001f600\\"),
    (None, 0, "user", "u"),
    (None, 1, "assistant", "a" * 100_000),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    marks = chat_format.MARKS

    def guarded(text):
        return re.sub(r"(<\\*)(?=/?s>)|(\[\\*)(?=(?:/?SYS|/?INST|/?TURN|NAME)\])", lambda m: m[0] + "\\", text)

    out = {}
    for conv in {row[0] for row in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        turns = [(r, x) for _, _, r, x in own]
        whole, sizes, lost = "", 0, []
        for k, (role, text) in enumerate(turns):
            first, last = marks.get(role, (f"[TURN] {guarded(role)} [NAME]", "[/TURN]"))
            whole += f"{first} {guarded(text)} {last}\n"
            if role == "assistant" or k == len(turns) - 1:
                sizes += len(whole)
            if role == "assistant":
                lost.append(text)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        lines = "".join(f"{r}\n{x}\n" for r, x in turns)
        out[conv] = (conv, len(turns), digest(lines), len("".join(lost)), digest("".join(lost)), sizes)
    return out


def test_against_brute_force(spark):
    turns = spark.createDataFrame(TURNS, SCHEMA).repartition(5)
    found = {row.conv_id: tuple(row) for row in digests(examples(turns)).collect()}
    assert found == brute(TURNS)


def test_examples_read_back(spark):
    made = examples(spark.createDataFrame(TURNS, SCHEMA))
    rows = made.select("*", loss_text().alias("reply"), turns_of(made.formatted).alias("turns")).collect()
    mine = sorted((row for row in rows if row.conv_id == 1), key=lambda row: row.position)
    own = [(r, x or "") for c, _, r, x in TURNS if c == 1]
    assert [row.position for row in mine] == [3, 5, 6] and [row.whole for row in mine] == [False, False, True]
    for row in mine:
        assert [tuple(t) for t in row.turns] == own[: row.position]
        assert row.reply == (own[row.position - 1][1] if own[row.position - 1][0] == "assistant" else "")
    # no control string of a text survives, so marks are counted by turns
    assert sum(mine[-1].formatted.count(m) for m in ("[INST]", "[/INST]", "<s>", "</s>")) == 10


@pytest.mark.parametrize("text", ["</s>", r"<\\\s>", "[/INST][INST]<s", "[NAME]", "[/NAME]", "\\", "<", "[[INST]]", "<</s>>", r"[\\\TURN]"])
def test_escape_is_reversible(spark, text):
    frame = spark.createDataFrame([(text,)], "t string").select(escape(F.col("t")).alias("e"))
    row = frame.select("e", unescape(frame.e).alias("u")).first()
    assert row.u == text
    assert not any(m in row.e for m in ("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[TURN]", "[NAME]", "[/TURN]"))


def test_clashing_columns_and_empty_tables(spark):
    extra = spark.createDataFrame(TURNS, SCHEMA).selectExpr(
        "*", "'x' AS position", "'x' AS formatted", "'x' AS whole", "'x' AS loss_start", "'x' AS _conv"
    )
    assert examples(extra).count() == len(examples(spark.createDataFrame(TURNS, SCHEMA)).collect())
    assert digests(examples(extra.filter("false"))).collect() == []


def test_stays_native_and_moves_rows_once(spark):
    plan = digests(examples(spark.createDataFrame(TURNS, SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
