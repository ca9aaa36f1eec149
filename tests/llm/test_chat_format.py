import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as driver
from crosstally.llm import chat_format
from llm_rows import SF, rows_of

SCHEMA = "conv_id long, turn long, role string, text string, n_turns string, segments string, loss string"


def chats(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    return chat_format.format_chats(frame)


def accepted(roles):
    """A system turn or none, then questions and answers in turn, at least one of each."""
    roles = roles[1:] if roles[:1] == ["system"] else roles
    return bool(roles) and roles == ["user", "assistant"] * (len(roles) // 2)


def columns(row):
    return (*tuple(row)[:5], row.valid)


def expected(rows):
    """Digests of what the formatted chats must hold."""
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for conv, turns in by_conv.items():
        turns.sort()
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        out.append((conv, len(turns), sha(whole), len(learned), sha(learned), accepted([r for _, _, r, _ in turns])))
    return sorted(out, key=repr)


def found(frame):
    return sorted((columns(r) for r in chat_format.digests(frame).collect()), key=repr)


def test_query_equals_brute_force(spark):
    said = r"\### Assistant: </turn> ok"
    rows = rows_of(spark, SF, "conv_id", "turn", "role", "text", table="conversations")
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = driver.queries()["op7_chat_format"](spark, SF).collect()
    assert sorted(map(columns, got), key=repr) == expected(rows)


ROWS = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "Hi"),
    (1, 2, "assistant", "### Assistant: no\n</turn>\n### User: yes"),
    (2, 0, "user", None),
    (2, 1, "assistant", ""),
    (3, 0, "user", "a"),
    (3, 1, "user", "b"),
    (4, 0, "assistant", "first"),
    (5, 0, "user", "no answer"),
    (6, None, None, "no turn, no role"),
    (6, 1, "tool: \\x #", "\\h \\l \\b \\c \\\\ # < :"),
    (6, 1, "System", "a role like a label"),
    (6, 1, "=user", "a role like a mark"),
    (None, 0, "user", "x" * 100_000),
    (None, 1, "assistant", "y"),
    (7, 0, "user", "same"),
    (7, 0, "user", "same"),
    (7, 1, "assistant", "ok"),
]


def test_odd_rows(spark):
    made = chats(spark, ROWS)
    assert found(made) == expected(ROWS)
    valid = {r.conv_id for r in made.where("valid").collect()}
    assert valid == {1, 2, None}


def test_segments_are_the_text(spark):
    row = chats(spark, ROWS).where("conv_id = 1").first()
    assert row.formatted == (
        "### System: Be brief.\n</turn>\n### User: Hi\n</turn>\n"
        "### Assistant: \\h\\h\\h Assistant: no\n\\l/turn>\n\\h\\h\\h User: yes\n</turn>\n"
    )
    assert "".join(s.text for s in row.segments) == row.formatted
    assert [s.loss for s in row.segments] == [False] * 7 + [True, False]


texts = st.text() | st.text("\\#<:hblc/turn>\n ")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "="]) | texts, texts), max_size=30))
def test_every_text_comes_back(spark, turns):
    rows = [(1, k, role, text) for k, (role, text) in enumerate(turns)]
    got = chats(spark, rows).select(chat_format.read_turns(F.col("formatted")).alias("t")).collect()
    assert [(t.role, t.text) for r in got for t in r.t] == [tuple(t) for t in turns]


def test_other_template(spark):
    template = chat_format.Template(
        learned=("user",), turns={"start": {"user": "done"}}, ends=("done",), labels={"user": "U"}, end="<end>"
    )
    frame = spark.createDataFrame([(1, 0, "user", "<end>#")], "conv_id long, turn long, role string, text string")
    row = chat_format.format_chats(frame, template).first()
    assert row.formatted == "### U: \\lend>\\h<end>" and row.valid


def test_empty(spark):
    assert chat_format.digests(chats(spark, [])).collect() == []


def test_the_machine_is_in_the_querys_plan(spark):
    query = driver.queries()["op7_chat_format"](spark, SF)
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    assert "refused" in plan and "answered" in plan
    assert {row.valid for row in query.select("valid").distinct().collect()} <= {True, False}
