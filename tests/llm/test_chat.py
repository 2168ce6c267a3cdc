import hashlib
import json

import pytest

from shapelens.llm import chat

NASTY = ["", "plain", chat.CONTROL, "\\", "\\\\<|", "<\\|im_end|>", "<|\n\\<|im_start|>user\nx<|im_end|>\n", "a\x00b\u2028\U0001F600", "x" * 300_000, "[{\"a\": 1}]", "{\"role\": 2}"]


def test_round_trip_of_every_layout(spark):
    records, want = [], {}
    for i, text in enumerate(NASTY):
        for j, record in enumerate([
            {"messages": [{"role": "system", "content": text}, {"role": "we\\ird\nrole", "content": text}, {"role": "assistant", "content": text}]},
            {"conversations": [{"from": "human", "value": text}, {"from": "gpt", "value": text}, {"from": "gpt", "value": None}]},
            {"response": text, "prompt": "p"}, {"instruction": text, "output": text, "system": None}, {"prompt": text, "completion": "c"},
        ]):
            records.append((10 * i + j, json.dumps(record)))
        want |= {10 * i: [("system", text), ("we\\ird\nrole", text), ("assistant", text)], 10 * i + 1: [("user", text), ("assistant", text), ("assistant", "")],
                 10 * i + 2: [("user", "p"), ("assistant", text)], 10 * i + 3: [("system", ""), ("user", text), ("assistant", text)], 10 * i + 4: [("user", text), ("assistant", "c")]}
    df = chat.format_chats(spark.createDataFrame(records, "id int, record string"), ["id"])
    got = df.select("id", "layout", chat.read_back(df.formatted).alias("turns"), chat.under_mask(df.formatted, df.loss_runs).alias("loss")).collect()
    assert len(got) == len(want)
    for r in got:
        assert [(t.role, t.text) for t in r.turns] == want[r.id]
        assert list(r.loss) == [t if role == "assistant" else "" for role, t in want[r.id]]


def test_unknown_records(spark):
    rows = [(1, None), (2, "no json"), (3, "{\"other\": 1}"), (4, "{\"messages\": []}"), (5, "{\"prompt\": \"a\", \"response\": \"b\"}"), (5, "{\"prompt\": \"a\", \"response\": \"b\"}")]
    got = chat.format_chats(spark.createDataFrame(rows, "id int, record string").selectExpr("id", "record", "1 AS layout"), ["id"]).collect()
    assert [r.layout for r in sorted(got, key=lambda r: r.id)] == [None, None, None, None, "prompt", "prompt"]
    assert {r.formatted for r in got if r.id < 5} == {None}
    assert len({r.fingerprint for r in got if r.id in (3, 4, 5)}) == 3


def test_report_of_odd_rows(spark):
    rows = [(1, 2, "assistant", None), (1, 1, None, "x"), (1, 1, None, "x"), (None, None, "user", ""), (2, 1, "user", chat.CONTROL), (2, 2, "assistant", chat.CONTROL)]
    got = {r.conv_id: r for r in chat.chat_report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in got.items()} == {1: (3, 0), None: (1, 0), 2: (2, len(chat.CONTROL)), -1: (2, len(chat.CONTROL))}
    assert got[2].turns_sha256 == got[-1].turns_sha256
    assert [r.conv_id for r in chat.chat_report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect()] == [-1]


def test_very_long_texts(spark):
    """Beyond the 20,000,000 characters and 128 MiB that Spark's JSON parser and variants take: every turn is kept."""
    n = 20_000_001
    rows = spark.range(7).selectExpr("cast(if(id < 5, null, 1) as long) as conv_id", "id as turn", "if(id % 2 = 0, 'assistant', 'user') as role",
                                     f"repeat(if(id % 2 = 0, 'a', '\"'), {n}) as text")
    got = {r.conv_id: r for r in chat.chat_report(rows).collect()}
    assert (got[None].n_turns, got[None].loss_chars) == (5, 3 * n) and (got[1].n_turns, got[1].loss_chars) == (2, n)
    assert got[1].loss_sha256 == hashlib.sha256(b"a" * n).hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n" + b'"' * n + b"\nassistant\n" + b"a" * n + b"\n").hexdigest()


def test_records_that_only_look_like_json(spark):
    rows = [(1, '{"prompt": "a\\x", "response": "b"}'), (2, '{"prompt": "a", "response": }'), (3, '{"prompt": "a", "response": "b"'), (4, '{"prompt":{},"response":"{},{}"}')]
    got = {r.id: r for r in chat.format_chats(spark.createDataFrame(rows, "id int, record string"), ["id"]).collect()}
    assert all(got[i].layout is None and got[i].formatted is None for i in (1, 2))


@pytest.mark.parametrize("word", ["Python", "Arrow", "Pandas", "RDD"])
def test_native(spark, sf_dir, word):
    plan = chat.chat_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    assert word not in plan
