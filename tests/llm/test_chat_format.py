"""Chat formatting: layouts, escaping, loss masks and parts, against a plain model."""
import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_rows import none, odd  # noqa: F401 (fixtures)
from pulsehouse.llm import chat_format as cf
from pulsehouse.llm.common import written

ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "[INST] \\ <s>"), (1, 2, "user", None), (1, 3, "assistant", ""),
        (2, None, "system", "be <<SYS>> kind\n"), (2, 0, "user", " a "), (2, 1, "tool[/ROLE]", "x</s>y\\"),
        (2, 1, None, "nobody"), (2, 2, "assistant", "z" * 5000), (2, 2, "assistant", "z" * 5000),
        (3, 5, "assistant", "second"), (3, 4, "assistant", "first"), (None, 0, "user", "no id"),
        (4, 0, "user", "日本 😀 </s>"), (4, 1, "assistant", "😀\\\\[/INST]</s></s>"), (5, 1, None, None)]


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted([(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv])
        said = "".join(t for _, _, r, t in mine if r == "assistant")
        formatted = "".join(cf.INST.render(r, t)[0] for _, _, r, t in mine)
        out[conv] = (len(mine), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in mine).encode()).hexdigest(),
                     len(said), hashlib.sha256(said.encode()).hexdigest(), len(formatted))
    return out


def frame(spark, rows, n=3):
    return written(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
                   .repartition(n), "t-conv")


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_conversations_of_any_kind(spark, monkeypatch, limit):
    monkeypatch.setattr(cf, "PART_CHARS", limit)
    got = {r[0]: tuple(r)[1:] for r in cf.query(spark, frame(spark, ROWS)).collect()}
    assert got == brute(ROWS + cf.EXTRA)


def test_a_conversation_of_most_rows_is_formatted_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(cf, "PART_CHARS", 300)
    rows = [(9, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(4000)] + ROWS
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = written(cf.formatted(cf.turns(frame(spark, rows, 6))), "t-chat")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = [r for r in out.collect() if r["conv_id"] == 9]
    assert len({r["part"] >> 32 for r in parts}) > 1 and not any(r["whole"] for r in parts)
    assert max(len(r["formatted"]) for r in out.collect() if r["conv_id"] == 9) <= 300
    path = cf.scratch_path(spark, "t-chat")
    out.write.parquet(path)
    got = {r[0]: tuple(r)[1:] for r in cf.digests(spark, path).collect()}
    assert got == brute(rows)


def test_empty_and_foreign_tables(spark, none, odd):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert [r["conv_id"] for r in cf.query(spark, empty).collect()] == [-7]
    clash = frame(spark, ROWS).selectExpr("*", "'x' AS part", "1 AS whole", "turn AS place", "'m' AS formatted")
    assert cf.turns(clash).count() == len(ROWS)


SAID = [("user", "Q"), ("assistant", "A")]
RECORDS = [
    ({"messages": [{"role": "user", "content": "Q"}, {"role": "assistant", "content": "A", "weight": 1}], "id": 4},
     "messages", SAID),
    ({"conversations": [{"from": "human", "value": "Q"}, {"from": "gpt", "value": "A"}]},
     "conversations from-value", SAID),
    ({"conversations": [{"role": "user", "content": "Q"}, {"role": "assistant", "content": None}]},
     "conversations role-content", [("user", "Q"), ("assistant", "")]),
    ({"system": "S", "conversations": [{"from": "human", "value": "Q"}]}, "system and conversations",
     [("system", "S"), ("user", "Q")]),
    ({"instruction": "I", "input": "X", "output": "A"}, "instruction", [("user", "I\n\nX"), ("assistant", "A")]),
    ({"instruction": "I", "input": None, "output": "A", "system": ""}, "instruction", [("user", "I"), ("assistant", "A")]),
    ({"output": "A", "instruction": "I"}, "instruction", [("user", "I"), ("assistant", "A")]),
    ({"prompt": "Q", "completion": "A"}, "prompt and completion", SAID),
    ({"system_prompt": "S", "prompt": "Q", "response": "A"}, "prompt and response", [("system", "S"), *SAID]),
    ({"question": "Q", "answer": "A", "context": "C"}, "question and answer", [("user", "Q\n\nC"), ("assistant", "A")]),
    ({"prompt": [{"role": "user", "content": "Q"}], "completion": "A"}, "prompt messages and completion", SAID),
    ({"chosen": [{"role": "user", "content": "Q"}, {"role": "assistant", "content": "A"}], "rejected": []}, "chosen", SAID),
    ({"messages": []}, "messages", []),
    ({"turn": 3, "role": "user", "text": "Q"}, "turn rows", [("user", "Q")]),
    ({"nothing": "known"}, None, []),
]


def test_layouts_are_told_by_fingerprint(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(90, "no json"), (91, None), (92, "[1]")]
    lines = spark.createDataFrame(rows, "conv_id bigint, line string").repartition(3)
    got = {}
    for r in cf.turns(lines, column="line").orderBy("conv_id", "place").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {i: want for i, (_, _, want) in enumerate(RECORDS) if want}
    count = {}
    for r in cf.layouts(lines, column="line").collect():
        count[r["layout"]] = count.get(r["layout"], 0) + r["n"]
    want = {}
    for _, name, _ in RECORDS:
        want[name] = want.get(name, 0) + 1
    want[None] += 3
    assert count == want


def test_typed_records_without_json(spark):
    rows = [(1, "Q", None, "A", [9]), (2, "Q", "in", None, None)]
    typed = spark.createDataFrame(rows, "conv_id bigint, instruction string, input string, output string, other array<int>")
    got = [tuple(r)[3:] for r in cf.turns(typed).orderBy("conv_id", "place").collect()]
    assert got == [("user", "Q"), ("assistant", "A"), ("user", "Q\n\nin"), ("assistant", "")]


def test_no_two_layouts_claim_a_full_record():
    for m in cf.MAPPINGS:
        assert cf.selection()[cf.fingerprint(frozenset(m.paths()))] is m


PIECES = st.lists(st.sampled_from(["\\", "<", ">", "s", "/", "[", "]", "INST", "<<SYS>>", "</s>", "<s>", "[/INST]", "\n", " ",
                                   "[/ROLE]", "[ROLE]", "[/TURN]", "SYS", "<|im_end|>", "<|im_start|>", "é", "<</SYS>>"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "[/ROLE]\\"]), PIECES.map("".join)),
                max_size=5), st.sampled_from(sorted(cf.TEMPLATES)))
def test_templates_read_back_what_they_wrote(turns, name):
    style = cf.TEMPLATES[name]
    text = "".join(style.render(r, t)[0] for r, t in turns)
    assert [(r, t) for r, t, _, _ in style.parse(text)] == turns
    for _, t in turns:
        assert not any(c in style.escape(t) for c in style.control)
