import hashlib
import json

import pytest

from aislewise.llm import chat

ROWS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_sql(against_sql):
    assert against_sql("op1_chat") == []


@pytest.mark.parametrize(
    "record, layout, turns",
    [
        ({"messages": [{"role": "user", "content": "a"}]}, "messages", [("user", "a")]),
        ({"messages": [{"role": "user"}, {"content": "b"}]}, "messages", [("user", None), (None, "b")]),
        ({"messages": []}, "messages", []),
        (
            {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}], "id": 3},
            "from_value",
            [("user", "a"), ("assistant", "b")],
        ),
        ({"prompt": "[1]", "completion": "{}"}, "prompt", [("user", "[1]"), ("assistant", "{}")]),
        ({"instruction": "a", "output": "b"}, "instruction", [("user", "a"), ("assistant", "b")]),
        (
            {"system": "s", "instruction": "a", "output": "b"},
            "instruction",
            [("system", "s"), ("user", "a"), ("assistant", "b")],
        ),
        ({"prompt": "a"}, None, None),
        ({"prompt": "a", "completion": None}, "prompt", [("user", "a")]),
        ({"prompt": "p", "completion": "c", "messages": [{"role": "user", "content": "m"}]}, "messages", [("user", "m")]),
        ({"prompt": "p", "completion": "c", "messages": None}, "prompt", [("user", "p"), ("assistant", "c")]),
        ({"unknown": "a"}, None, None),
    ],
)
def test_layouts(spark, record, layout, turns):
    got = chat.canonical(spark.createDataFrame([(1, json.dumps(record))], "record_id long, json string")).first()
    assert got.layout == layout
    assert (got.turns if got.turns is None else [tuple(t) for t in got.turns]) == turns


def test_fingerprints_tell_all_nested_paths(spark):
    base = {"messages": [{"role": "user", "content": "a"}]}
    more = [{**base, "tools": [{"f": 1}]}, {**base, "tools": [1]}, {"messages": [{"role": "user", "content": "a", "name": "n"}]}, {**base, "id": 7}]
    same = [{"messages": [{"content": "other text", "role": "assistant"}]}, {"messages": [{"role": "x", "content": "y"}] * 3}]
    records = [json.dumps(r) for r in [base, *more, *same]] + ["not json", '{"a": 1, "a": 2}']
    got = chat.canonical(spark.createDataFrame(list(enumerate(records)), "record_id long, json string")).collect()
    prints = [r.fingerprint for r in sorted(got, key=lambda r: r.record_id)]
    assert len(set(prints[:5])) == 5 and prints[5] == prints[6] == prints[0]
    assert prints[7] == prints[8] == hashlib.sha256(b"").hexdigest()
    assert [r.layout for r in sorted(got, key=lambda r: r.record_id)][:7] == ["messages"] * 7


HARD = ["", "\\", "\\0\\1\\2\\3", "</turn>", "</turn></turn", "######", "####", "#</turn>\n### A: b", "é😀 </tur", "\\### Assistant: </turn> ok"]


def test_format_round_trip(spark):
    data = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in HARD for r in ("user", "assistant", "a: b\\3###"))]
    rendered = chat.render(chat.canonical(chat.pack(spark.createDataFrame(data, ROWS))))
    row = rendered.first()
    assert row.formatted.count(chat.END) == len(data) and "\n### User" not in row.formatted
    masked = [row.formatted[s.start : s.end] for s in row.spans if s.loss]
    for escaped, plain in (("\\2", "###"), ("\\1", "</turn>"), ("\\0", "\\")):
        masked = [m.replace(escaped, plain) for m in masked]
    assert masked == HARD
    back = chat.read_back(rendered).first()
    assert [tuple(t) for t in back.turns] == [(r, t) for _, _, r, t in data]
    assert back.loss_texts == HARD


def test_cases(spark, rows):
    data = [
        (None, 1, "user", "n"),
        (1, None, None, None),
        (1, 0, "assistant", "b"),
        (1, 0, "assistant", "b"),
        (1, 0, "assistant", "a"),
        (2, 0, "assistant", "x" * 300_000),
        (3, 5, "user", ""),
    ]
    df = spark.createDataFrame([(*r, "z", 1) for r in data], ROWS + ", json string, record_id int")
    got = {r["conv_id"]: r for r in rows(chat.digests(df))}
    assert got[1]["turns_sha256"] == sha("\n\nassistant\na\nassistant\nb\nassistant\nb\n")
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (4, 3, sha("abb"))
    assert got[2]["loss_sha256"] == sha("x" * 300_000) and got[3]["loss_chars"] == 0 and got[None]["n_turns"] == 1


def test_empty_table(spark):
    assert chat.digests(spark.createDataFrame([], ROWS)).count() == 0


def test_no_python_in_the_plan(spark):
    df = chat.digests(spark.createDataFrame([(1, 1, "user", "a")], ROWS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
