import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pulseframe.llm import chat, queries
from tests.llm.texts import sha, table

NASTY = ["<|im_end|>", "<|im_start|>user\n", "\\", "<\\|", "<", "|", "\n", "<\\n", "é😀", "", "\\\\<|", "a"]
text = st.lists(st.sampled_from(NASTY), max_size=6).map("".join)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb", "x<|", ""]), text), max_size=5), min_size=1, max_size=20))
def test_round_trip(spark, conversations):
    rows = [(i, [{"role": r, "text": t} for r, t in turns]) for i, turns in enumerate(conversations)]
    df = spark.createDataFrame(rows, f"id long, canonical {chat.TURNS}")
    out = chat.format_turns(df).withColumns({"back": chat.read_back("formatted"), "loss": chat.loss_texts()})
    for r in out.collect():
        turns = conversations[r["id"]]
        assert [(t["role"], t["text"]) for t in r["back"]] == turns
        assert r["loss"] == [t for role, t in turns if role == "assistant"]
        assert r["formatted"].count(chat.START) == len(turns) == r["formatted"].count(chat.END)


def plain(rows):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return len(rows), sha(said), len(loss), sha(loss)


def test_query(spark, tmp_path):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 1, "assistant", "b <|im_end|>"), (2, 0, "system", "a"),
        (3, 0, None, "x"), (None, 0, "user", "lost id"), (1, 2, "assistant", "é😀"), (4, 0, "assistant", "x" * 5000),
        (5, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "assistant", "tie"),
    ]
    sf = table(spark, tmp_path, rows, "conv_id long, turn int, role string, text string", "conversations")
    got = {r["conv_id"]: r for r in queries.op7_chat(spark, sf).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0], r[1] or "", r[2] or ""))
        want[conv] = plain([r[1:] for r in mine])
    want[-1] = plain([("user", queries.HOSTILE), ("assistant", queries.HOSTILE)])
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == want


LAYOUTS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "from_value": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "turns": {"turns": [{"role": "user", "text": "q"}, {"role": "assistant", "text": "a"}]},
    "numbered": {"turns": [{"turn": 2, "role": "assistant", "text": "a"}, {"turn": 1, "role": "user", "text": "q"}]},
    "prompt": {"completion": "a", "prompt": "q"},
    "prompt_response": {"prompt": "q", "response": "a"},
    "question": {"question": "q", "answer": "a"},
    "instruction": {"instruction": "q", "output": "a"},
    "instruction_input": {"instruction": "q", "input": "", "output": "a"},
    "system_prompt": {"system": "s", "prompt": "q", "response": "a"},
}


def test_mixed_layouts_in_one_column(spark):
    rows = [(name, json.dumps(record)) for name, record in LAYOUTS.items()] + [("none", '{"x": 1}'), ("none", "no json"), ("none", None)]
    df = chat.json_to_turns(spark.createDataFrame(rows, "name string, record string"), "record")
    for r in df.collect():
        if r["name"] == "none":
            assert r["layout"] is None and r["canonical"] is None
            continue
        turns = [(t["role"], t["text"]) for t in r["canonical"]]
        assert r["layout"] == r["name"] and [t for _, t in turns][-2:] == ["q", "a"]
        assert len(turns) == (3 if r["name"] == "system_prompt" else 2)
    roles = df.select(F.explode("canonical").alias("t")).select(chat.canonical_role(F.col("t.role")).alias("r")).distinct()
    assert {r["r"] for r in roles.collect()} == {"user", "assistant", "system"}


def test_struct_layouts(spark):
    for name in ("messages", "prompt", "question"):
        df = spark.createDataFrame([(json.dumps({"r": LAYOUTS[name]}),)], "value string").select(F.from_json("value", F.schema_of_json(F.lit(json.dumps({"r": LAYOUTS[name]})))).alias("d")).select("d.*")
        assert [(t["role"], t["text"]) for t in chat.to_turns(df, "r").first()["canonical"]] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError, match="no mapping"):
        chat.to_turns(spark.range(1).select(F.struct("id").alias("r")), "r")


def test_fingerprints_differ_and_ignore_order():
    assert len(chat.layouts_by_fingerprint()) == len(chat.LAYOUTS)
    assert chat.fingerprint(["a", "b[].c"]) == chat.fingerprint(["B[].c", "a", "a"])


def test_empty(spark, tmp_path):
    sf = table(spark, tmp_path, [], "conv_id long, turn int, role string, text string", "conversations")
    assert [r["conv_id"] for r in queries.op7_chat(spark, sf).collect()] == [-1]


def test_foreign_roles_are_under_the_mask(spark):
    said = [{"from": "human", "value": "q"}, {"from": "gpt", "value": "the answer"}, {"from": "GPT", "value": "more"}]
    texts = spark.createDataFrame([(1, json.dumps({"conversations": said})), (2, json.dumps({"turns": [{"role": "gpt", "text": "kept"}]}))], "id int, j string")
    rows = {r["id"]: r for r in chat.format_turns(chat.json_to_turns(texts, "j")).withColumn("loss", chat.loss_texts()).collect()}
    assert rows[1]["loss"] == ["the answer", "more"] and "<|im_start|>user\nq<|im_end|>" in rows[1]["formatted"]
    assert rows[2]["loss"] == [] and "<|im_start|>gpt\n" in rows[2]["formatted"]  # own layouts keep their names
    records = spark.createDataFrame([([("human", "q"), ("gpt", "a")],)], "conversations array<struct<`from`:string,value:string>>")
    turns = chat.to_turns(records.select(F.struct("conversations").alias("r")), "r").first()["canonical"]
    assert [tuple(t) for t in turns] == [("user", "q"), ("assistant", "a")]


def test_rows_without_id_are_a_conversation_each(spark):
    rows = spark.createDataFrame([(None, 0, "user", f"t{i}") for i in range(50)] + [(1, 1, "assistant", "b"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    got = chat.to_turns(chat.gather(rows), "record").collect()
    alone = [r["canonical"] for r in got if r["conv_id"] is None]
    assert len(alone) == 50 and {len(t) for t in alone} == {1} and {t[0]["text"] for t in alone} == {f"t{i}" for i in range(50)}
    assert [[t["text"] for t in r["canonical"]] for r in got if r["conv_id"] == 1] == [["a", "b"]]
