from __future__ import annotations

import random

from hypothesis import given
from hypothesis import strategies as st

import pytest
from pyspark.sql import functions as F

from strata.llm.chat_format import BEGIN, CONTROL, escape, format_conversations, format_turn, parse, read_back, unescape

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PIECES = st.sampled_from([*CONTROL, "\\", "\\l", "\\n", "<", "[", "|", ">", "a", "\n", "é"])


@given(st.lists(PIECES, max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROL)


@given(st.lists(st.tuples(st.lists(PIECES, max_size=4).map("".join), st.lists(PIECES, max_size=6).map("".join)), max_size=4))
def test_template_round_trip(turns):
    text = "".join(format_turn(r, t, k == 0)[0] for k, (r, t) in enumerate(turns))
    assert parse(text) == turns


def tree(spark, convs):
    rows = [(i, k, r, t) for i, turns in convs.items() for k, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    stream, members = format_conversations(spark.createDataFrame(rows, SCHEMA))
    return stream, members, {r.leaf: r for r in read_back(stream).collect()}


def test_shared_turns_are_emitted_once_depth_first(spark):
    s, a, b = ("system", "be kind"), ("user", "hi"), ("assistant", "hello")
    convs = {1: [s, a, b], 2: [s, a, ("assistant", "no")], 3: [s, a, b, ("user", "more"), ("assistant", "x")], 4: [s, a, b], 5: [s]}
    stream, members, read = tree(spark, convs)
    rows = sorted(stream.collect(), key=lambda r: r.start)
    assert len({r.pack for r in rows}) == 1 and len(rows) == 6  # s, a, hello, more, x, no
    at = 0
    for r in rows:
        assert r.start == at and r.stop == at + len(r.text)
        at = r.stop
    emitted = "".join(r.text for r in rows)
    for r in rows:
        before = "".join(emitted[i.start : i.stop] for i in r.intervals)
        assert len(before) == r.position and (before + r.text).startswith(BEGIN)
        assert r.depth == before.count("<|im_start|>")
        assert (r.loss_start is None) == ("assistant" not in r.text)
    last = next(r for r in rows if ">no" in r.text.replace("\n", ">"))
    assert max(len(r.intervals) for r in rows) == 1 or last.depth == 2
    got = {m.conv_id: read[m.leaf] for m in members.collect()}
    assert {k: [(t.role, t.text) for t in r.turns] for k, r in got.items()} == convs
    assert [got[3].formatted[x.start : x.stop] for x in got[3].loss] == ["hello", "x"] == got[3].loss_texts


def test_many_trees_against_the_input(spark):
    r = random.Random(7)
    texts = ["", "a", "</s>", "[INST] x [/INST]", "\\", "long " * 2000, "é\n"]
    convs = {i: [(("user", "assistant")[k % 2], r.choice(texts)) for k in range(r.randint(1, 6))] for i in range(150)}
    convs[500] = [(("user", "assistant")[k % 2], f"turn {k}") for k in range(300)]
    stream, members, read = tree(spark, convs)
    got = {m.conv_id: [(t.role, t.text) for t in read[m.leaf].turns] for m in members.collect()}
    assert got == convs
    nodes = {tuple(t[: k + 1]) for t in convs.values() for k in range(len(t))}
    assert stream.count() >= len(nodes)
    tasks = stream.selectExpr("shiftright(pack, 32) as task").distinct().count()
    assert stream.count() <= len(nodes) + 6 * tasks  # a task repeats at most the path it starts on


def test_edge_cases(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, 5, "user", "n"), (None, None, "user", "first"), (2, 0, "line\nfeed", "t")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as leaf", "'y' as path", "'z' as pack")
    stream, members = format_conversations(frame)
    read = {r.leaf: r for r in read_back(stream).collect()}
    got = sorted(((m.conv_id, [(t.role, t.text) for t in read[m.leaf].turns]) for m in members.collect()), key=str)
    assert got == sorted([(1, [("user", ""), ("", "x"), ("", "x")]), (None, [("user", "first")]), (None, [("user", "n")]), (2, [("line\nfeed", "t")])], key=str)
    stream, members = format_conversations(spark.createDataFrame([], SCHEMA))
    assert stream.count() == members.count() == read_back(stream).count() == 0


def test_one_conversation_of_many_turns(spark):
    """Work grows with the turns, not with their square."""
    import time

    began = time.time()
    n = 50_000
    rows = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "CASE WHEN id % 2 = 0 THEN 'user' ELSE 'assistant' END AS role", "concat('turn ', id) AS text")
    stream, members = format_conversations(rows)
    read = read_back(stream).first()
    assert len(read.turns) == n and read.turns[-1].text == f"turn {n - 1}" and len(read.loss) == n // 2
    assert members.count() == 1 and time.time() - began < 60


def test_wrong_intervals_are_noticed(spark):
    stream, _ = format_conversations(spark.createDataFrame([(1, k, "user", f"t{k}") for k in range(4)], SCHEMA))
    wrong = stream.withColumn("intervals", F.when(F.col("depth") == 2, F.slice("intervals", 1, 0)).otherwise(F.col("intervals")))
    with pytest.raises(Exception, match="do not cover"):
        read_back(wrong).collect()
