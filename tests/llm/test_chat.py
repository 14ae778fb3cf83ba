import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from qmeasures.llm import chat

CONTROL = re.compile(r"\[\\*/?(?:INST|ROLE)\]|<\\*(?:/?s>|</?SYS>>)")
FRAGMENTS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "<<SYS>>", "<</SYS>>", "\\", "<", ">", "[", "]", "/",
             "<\\s>", "[\\\\INST]", "<\\</SYS>>", " ", "\n", "a", "é", "\U0001F600", "s", "INST", "SYS>>", "$1", "[/INST] ", ""]
SCHEMA = "conv_id long, turn long, role string, text string"


def written(role, text):
    """The template by hand, every conflicting turn escaped."""
    role, text = (CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], x) for x in (role, text))
    known = {"system": f"<<SYS>>{text}<</SYS>>", "user": f"[INST] {text} [/INST]", "assistant": f" {text}</s>"}
    return known.get(role, f"[ROLE]{role}[/ROLE] {text}</s>")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    """conv_id -> the query's row, from the source rows."""
    out, chats = {}, {}
    key = lambda r: ((r[1] is not None, r[1] or 0), r[2].encode(), r[3].encode())
    for conv, turn, role, text in rows:
        chats.setdefault(conv, []).append((conv, turn, role or "", text or ""))
    for conv, turns in chats.items():
        turns = [t[2:] for t in sorted(turns, key=key)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                     3 + sum(len(written(*t)) for t in turns))
    return out


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", piece string, formatted int")
    chats = chat.format_chats(df).persist()
    found = {r[0]: tuple(r[1:]) for r in chat.read_chats(chats).collect()}
    assert len(found) == chats.count()
    return found, {r.conv_id: r for r in chats.collect()}


def test_every_fragment_comes_back(spark):
    rng = random.Random(3)
    text = lambda: "".join(rng.choices(FRAGMENTS, k=rng.randint(0, 9)))
    roles = ["user", "assistant", "system", "tool", None, "", "[/ROLE]", "a</s>", "\\", "User"]
    rows = [(i // 6, i % 6, rng.choice(roles + [text()]), text()) for i in range(6000)]
    found, chats = got(spark, rows)
    assert found == expected(rows)
    for conv in range(20):
        turns = [r for r in rows if r[0] == conv]
        assert chats[conv].formatted == "<s>" + "".join(written(r or "", t) for _, _, r, t in turns)
        for span, (_, _, role, body) in zip(chats[conv].spans, turns):
            part = chats[conv].formatted[span.start:span.end]
            assert part == written(role or "", body)
            assert (span.loss_start is None) == (role != "assistant")
            if role == "assistant":
                assert " " + chats[conv].formatted[span.loss_start:span.loss_end] + "</s>" == part


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 0, "assistant", "b"), (1, None, None, "first"),
            (None, 5, "assistant", "x"), (None, 5, "assistant", "x"), (2, 1, "assistant", "</s>" * 50_000),
            (2, 0, "system", "<<SYS>> " + "long ü " * 100_000), (3, 0, "user", "no answer")]
    assert got(spark, rows)[0] == expected(rows)
    assert got(spark, [])[0] == {}


def test_long_conversation(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} é" + "[INST]" * (i % 3)) for i in range(5000)]
    assert got(spark, rows)[0] == expected(rows)


@pytest.mark.parametrize("text", ["", "[INST] a [/INST]", "<s>[INST] a", "<s>[INST] a</s>", "<s> a [INST] b</s>", "<s>x</s>",
                                  "<s>[ROLE]user[/ROLE] a</s>", "<s> a</s> ", "<s>[INST] [/INST]", "<s>[ROLE]a</s>"])
def test_no_reading_outside_the_grammar(spark, text):
    turns = spark.range(1).select(chat.parse(F.lit(text)).alias("t")).first().t
    assert turns is None or any(t.role is None or t.text is None for t in turns)
    if text == "<s>":
        assert turns == []


def test_a_changed_mask_is_seen(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], SCHEMA)
    short = chat.format_chats(df).withColumn("spans", F.slice("spans", 1, 1))
    assert chat.read_chats(short).first().loss_sha256 is None


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "q")], SCHEMA).limit(1)
    for frame in (chat.format_chats(df), chat.read_chats(chat.format_chats(df))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
