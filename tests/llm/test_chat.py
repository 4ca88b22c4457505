import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clipwire.llm import chat
from clipwire.llm.queries import llm_queries

PARTS = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/s>", "a", "é", "\n", '"'])
TEXT = st.lists(PARTS, max_size=12).map("".join)


def through(spark, conversations):
    """Turns and loss text of lists of (role, text), formatted and read back."""
    rows = [(k, n, r, t) for k, c in enumerate(conversations) for n, (r, t) in enumerate(c)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_turns(chat.canonical_turns(chat.records_of(df)))
    read = made.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    return {r.conv_id: r for r in read.collect()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<s>"]), TEXT), min_size=1, max_size=4), min_size=1, max_size=30))
def test_round_trip(spark, conversations):
    got = through(spark, conversations)
    for k, c in enumerate(conversations):
        assert [tuple(t) for t in got[k].turns] == c
        assert got[k].loss == "".join(t for r, t in c if r == "assistant")
        assert got[k].formatted.count("</s>") == len(c) == got[k].formatted.count("<s>")


def test_layouts(spark):
    records = [
        {"prompt": "p", "completion": "c"},
        {"completion": "c", "prompt": None},
        {"question": "q", "answer": "a"},
        {"instruction": "i", "input": "", "output": "o"},
        {"instruction": "i", "input": "x", "output": "o"},
        {"messages": [{"role": "user", "content": "m"}, {"content": "n", "role": None}]},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"prompt": "p", "completion": "c", "id": 3},
        {"messages": []},
        "no object",
    ]
    rows = [(k, json.dumps(r)) for k, r in enumerate(records)] + [(90, None), (91, "{broken"), (92, "")]
    df = spark.createDataFrame(rows, "id int, record string").withColumns(
        {"layout": F.lit(1), "turns": F.lit("x"), "blocks": F.lit(2), "formatted": F.lit(3)}
    )
    made = chat.format_turns(chat.canonical_turns(df))
    got = {r.id: r for r in made.collect()}
    turns = {k: [tuple(t) for t in r.turns] if r.turns is not None else None for k, r in got.items()}
    assert turns[0] == [("user", "p"), ("assistant", "c")]
    assert turns[1] == [("user", ""), ("assistant", "c")]
    assert turns[2] == [("user", "q"), ("assistant", "a")]
    assert turns[3] == [("system", "i"), ("assistant", "o")]
    assert turns[4] == [("system", "i"), ("user", "x"), ("assistant", "o")]
    assert turns[5] == [("user", "m"), ("", "n")]
    assert turns[6] == [("user", "h"), ("assistant", "g")]
    for k in (7, 8, 9, 90, 91, 92):
        assert got[k].layout is None and turns[k] is None and got[k].formatted == "" and not got[k].loss_spans
    assert got[0].schema_fingerprint == got[1].schema_fingerprint != got[7].schema_fingerprint


def test_odd_conversations(spark):
    rows = [
        (None, 0, "user", "n"),
        (1, None, None, None),
        (1, 0, "assistant", "a" * 300_000),
        (1, 0, "assistant", "a" * 300_000),
        (2, 0, "user", "same"),
        (2, 0, "user", "same"),
        (3, 5, "system", "s"), (3, 6, "user", ""), (3, 7, "assistant", "x\x00 "),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({"t": F.lit(1), "record": F.lit(2)})
    made = chat.canonical_turns(chat.records_of(df))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in made.collect()}
    assert got[None] == [("user", "n")]
    assert got[1] == [("", "")] + 2 * [("assistant", "a" * 300_000)]
    assert got[2] == 2 * [("user", "same")]
    assert got[3] == [("system", "s"), ("user", ""), ("assistant", "x\x00 ")]
    assert chat.records_of(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = llm_queries()["op8_chat_schema_fingerprint"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_conversations_beyond_the_parsers_limits(spark):
    """A text of over 20 million characters, and a record of over 128 MiB."""
    long, part = 20_500_000, 8_500_000
    rows = [(1, 0, "user", "q", 1), (1, 1, "assistant", 'a "b": \\', long // 8)]
    rows += [(2, 0, "user", "x", long), (2, 1, "user", "y", 1), (2, 2, "assistant", "z", 1)]
    rows += [(3, k, ("user", "assistant")[k % 2], "w", part) for k in range(16)]
    rows += [(4, k, "user", f"{k}", 1) for k in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    df = df.withColumn("text", F.expr("repeat(text, n)"))
    made = chat.canonical_turns(chat.records_of(df))
    sizes = F.transform("turns", lambda t: F.length(t["text"])).alias("sizes")
    got = {r.conv_id: (r.layout, r.sizes) for r in made.select("conv_id", "layout", sizes).collect()}
    assert got == {
        1: ("prompt", [1, long // 8 * 8]),
        2: ("messages", [long, 1, 1]),
        3: ("messages", [part] * 16),
        4: ("messages", [1, 1, 1]),
    }


def test_large_records_have_the_paths_of_small_ones(spark, monkeypatch):
    records = [
        '{"messages": [{"role": "us\\"er", "content": "a: \\\\"}, {"role": "", "content": null}]}',
        '{"prompt" : "{\\"x\\": [1, 2]}", "completion": "c", "meta": [{"k": 1.5}, {"k": "s"}, {"j": []}]}',
        '["a", "b", {"c": {"d": "e"}}, {"c": {"d": "f"}}]',
    ]
    df = spark.createDataFrame([(r,) for r in records], "record string")
    before = [r[0] for r in df.select(chat.paths(F.col("record"))).collect()]
    monkeypatch.setattr(chat, "LARGE", 10)
    assert [r[0] for r in df.select(chat.paths(F.col("record"))).collect()] == before


def test_records_that_are_no_json_keep_their_row_at_any_size(spark, monkeypatch):
    records = ['{"messages": [{"role": "x"', '{"prompt": "bad \\q escape", "completion": "c"}', "no", "", None]
    df = spark.createDataFrame([(r,) for r in records], "record string")
    for large in (8 << 20, 0):
        monkeypatch.setattr(chat, "LARGE", large)
        got = chat.canonical_turns(df).collect()
        assert [(r.layout, r.turns) for r in got] == [(None, None)] * 5
        assert chat.format_turns(chat.canonical_turns(df)).count() == 5


def test_json_that_the_parser_cannot_hold_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(chat, "LARGE", 10)
    monkeypatch.setattr(chat, "UNREAD", 20)
    monkeypatch.setattr(chat.F, "try_parse_json", lambda c: F.lit(None).cast("variant"))
    df = spark.createDataFrame([('{"prompt": "p", "completion": "c", "more": 1}',)], "record string")
    with pytest.raises(Exception, match="cannot be read"):
        chat.canonical_turns(df).collect()
