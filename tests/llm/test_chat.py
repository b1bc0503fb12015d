"""Chat formatting: layouts, escapes and exact round trips."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from rankstream.llm import catalog, chat

TEXT = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "/", "]", ">", "s", "é", "\n", "漢", "𝒜"])).map("".join)
ROLE = st.sampled_from(["user", "assistant", "system", "tool", "[/ROLE]x\\"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
def test_round_trip(turns):
    whole, spans = chat.formatted(turns)
    assert chat.parsed(whole) == turns
    learned = [chat.unescape(whole[a:b]) for a, b in spans]
    assert learned == [t for r, t in turns if r == "assistant"]


def test_layouts():
    same = [("user", "q"), ("assistant", "a")]
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 3},
        {"instruction": "q", "output": "a", "meta": {"x": [1]}},
        {"prompt": "q", "completion": "a"}, {"prompt": "q", "response": "a"},
        {"question": "q", "answer": "a"},
    ]
    assert [chat.canonical(r) for r in records] == [same] * len(records)
    assert len({chat.fingerprint(r) for r in records}) == len(records)
    assert chat.canonical({"instruction": "do", "input": "it", "output": None, "system": "s"}) == [
        ("system", "s"), ("user", "do\n\nit"), ("assistant", "")
    ]
    assert chat.canonical({"messages": []}) == []
    assert chat.canonical({"other": 1}) is None
    assert chat.fingerprint({"b": 1, "prompt": "x", "completion": ""}) == chat.fingerprint(
        {"completion": 1, "prompt": None}
    )


def test_unknown_and_broken_records_stay(spark):
    texts = [None, "", "{", "3", '{"z": 1}', '{"prompt": "a", "completion": "b"}']
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "id long, record string, extra string")
    rows = chat.with_format(df).orderBy("id").collect()
    assert [r.layout for r in rows] == [None] * 5 + ["prompt_completion"]
    assert rows[4].fingerprint and rows[5].formatted == "[INST]a[/INST]<s>b</s>"
    assert [tuple(s) for s in rows[5].loss] == [(17, 18)]


def direct(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, said in found.items():
        said.sort()
        turns = "".join(f"{r}\n{t}\n" for _, r, t in said)
        loss = "".join(t for _, r, t in said if r == "assistant")
        out[conv] = (len(said), hashlib.sha256(turns.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    probe = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    got = catalog.QUERIES["op4_schema_chat_format"](spark, sf_dir).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == direct(rows)
    assert all(r.formatted_chars > r.loss_chars for r in got)


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, None, None), (1, None, "user", "first"), (1, 1, "assistant", "b"),
            (None, 0, "user", "x"), (2, 0, "user", "</s>" * 50_000), (2, 1, "assistant", '"\\\n\u2028')]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.with_format(chat.conversation_records(df))
    read = made.select("conv_id", chat.read_back(made.formatted, made.loss).alias("r")).collect()
    assert {r.conv_id: tuple(r.r)[:4] for r in read} == direct(rows)
    assert chat.with_format(chat.conversation_records(df.limit(0))).collect() == []
    assert json.loads(chat.conversation_records(df).filter("conv_id is null").first().record)
