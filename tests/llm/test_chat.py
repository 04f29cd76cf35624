import hashlib
import json
from itertools import groupby

import pytest

from strandweave.llm.chat import canonical_json, canonical_turns, chat_digests, format_chats, layout_of, read_chats, unmatched_json

NASTY = "</s>[INST] ok [/INST] ~1 ~~0 <s>[user]\n \\ ~"


@pytest.fixture
def turns(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", NASTY), (1, 2, "assistant", None), (1, 2, "assistant", ""), (2, 0, None, None),
        (None, 5, "user", "x"), (None, None, "assistant", "first"), (3, 1, "us]er\n[", "\n\n"), (3, 0, "system", "日本\U0001f600"), (4, 0, "assistant", "z" * 50000),
        (1, 0, "user", "hi"),
    ]
    return spark.createDataFrame([(*r, "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, start string")


def by_hand(rows):
    key = lambda r: (r.turn is not None, r.turn or 0, r.role is not None, r.role or "", r.text is not None, r.text or "")
    rows = sorted(rows, key=lambda r: (str(r.conv_id), key(r)))
    for conv_id, group in groupby(rows, key=lambda r: r.conv_id):
        group = [(r.role or "", r.text or "") for r in group]
        learned = "".join(text for role, text in group if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        yield conv_id, len(group), sha("".join(f"{role}\n{text}\n" for role, text in group)), len(learned), sha(learned)


def test_round_trip(turns):
    got = chat_digests(format_chats(canonical_turns(turns))).drop("formatted_chars").collect()
    assert sorted(map(tuple, got), key=str) == sorted(by_hand(turns.collect()), key=str)


def test_a_text_cannot_hold_a_control_string(turns):
    formatted = {r.conv_id: r.formatted for r in format_chats(canonical_turns(turns)).collect()}
    assert formatted[1].count("</s>") == formatted[1].count("<s>[") == 5
    assert "[INST]" not in formatted[1]


def test_no_turns(turns):
    assert chat_digests(format_chats(canonical_turns(turns.where("false")))).collect() == []


RECORDS = [
    {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
    {"id": 7, "conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
    {"system": "s", "messages": [{"content": "a", "role": "user"}]},
    {"instruction": "a", "input": "", "output": "b"}, {"instruction": "a", "input": "c", "output": None},
    {"prompt": "a", "completion": "b"}, {"prompt": "a", "response": "b", "id": "z"}, {"question": "a", "answer": "b"}, {"unknown": 1}, [1], "text", None,
]
WANTED = {
    0: [("user", "a"), ("assistant", "b")], 1: [("user", "a"), ("assistant", "b")], 2: [("system", "s"), ("user", "a")],
    3: [("user", "a"), ("assistant", "b")], 4: [("user", "a"), ("user", "c"), ("assistant", None)], 5: [("user", "a"), ("assistant", "b")],
    6: [("user", "a"), ("assistant", "b")], 7: [("user", "a"), ("assistant", "b")],
}


def test_every_json_record_by_its_own_layout(spark):
    rows = [(i, json.dumps(r)) for i, r in enumerate(RECORDS)] + [(50, None), (51, "{broken")]
    got = canonical_json(spark.createDataFrame(rows, "n bigint, record string"), "record", "n").orderBy("conv_id", "turn").collect()
    assert {k: [(r.role, r.text) for r in g] for k, g in groupby(got, key=lambda r: r.conv_id)} == WANTED


def test_records_with_more_fields_than_their_layout(spark):
    records = [
        {"instruction": "a", "output": "b", "category": "c", "tags": ["x", {"y": 1}]},
        {"messages": [{"role": "user", "content": "a", "name": "n"}, {"role": "model", "content": "b", "extra": {"role": "z"}}], "meta": {"role": "q"}},
        {"system": "s", "prompt": "a", "completion": "b"}, {"text": "t", "question": "a", "answer": {"n": 1}},
        {"messages": "not a list", "prompt": "a", "response": "b"}, {"messages": [], "x": 1}, {"messages": [{"role": "user"}]}, {"meta": {"prompt": "a", "response": "b"}},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(50, None), (51, "{broken"), (52, "")], "n bigint, record string")
    got = canonical_json(df, "record", "n").orderBy("conv_id", "turn").collect()
    assert {k: [(r.role, r.text) for r in g] for k, g in groupby(got, key=lambda r: r.conv_id)} == {
        0: [("user", "a"), ("assistant", "b")], 1: [("user", "a"), ("assistant", "b")], 2: [("user", "a"), ("assistant", "b")],
        3: [("user", "a"), ("assistant", '{"n":1}')], 4: [("user", "a"), ("assistant", "b")]}
    left = {r.conv_id: r for r in unmatched_json(df, "record", "n").collect()}
    assert sorted(left) == [5, 6, 7, 50, 51, 52]
    assert "prompt" in left[7].paths and left[51].paths is None and len(left[5].fingerprint) == 64 and left[6].record == json.dumps(records[6])
    assert unmatched_json(df.where("false"), "record", "n").collect() == []


@pytest.mark.parametrize("schema, values, wanted", [
    ("id bigint, messages array<struct<role:string,content:string>>", (1, [("human", "a")]), [(1, 0, "user", "a")]),
    ("conv_id bigint, instruction string, output string, score double", (1, "a", "b", 0.5), [(1, 0, "user", "a"), (1, 1, "assistant", "b")]),
    ("id bigint, prompt string, response string, text string", (1, "a", "b", "t"), [(1, 0, "user", "a"), (1, 1, "assistant", "b")]),
])
def test_tables_in_other_layouts(spark, schema, values, wanted):
    assert [tuple(r) for r in canonical_turns(spark.createDataFrame([values], schema)).collect()] == wanted


def test_an_unknown_layout_is_an_error(spark):
    with pytest.raises(ValueError):
        layout_of(spark.createDataFrame([(1,)], "n bigint").schema)
