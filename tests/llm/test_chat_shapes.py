"""Shapes of records: what selects a layout, and that no text is lost under a name that nothing reads."""

import json

import pytest
from pyspark.sql import functions as F

from vitrine.llm import chat

SF = "/root/testdata/sf0.01"


def read(spark, *records):
    df = chat.canonical_turns(spark.createDataFrame([(i, r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(records)], "id int, record string"))
    return [(r.layout, None if r.turns is None else [tuple(t) for t in r.turns]) for r in sorted(df.collect(), key=lambda r: r.id)]


def paths_of(value, at=""):
    """Paths by walking the value, types by Python's: the slow version of field_paths."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths_of(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list):
        return {p for v in value for p in paths_of(v, at + "[]")}
    return {(at, {str: "STRING", bool: "BOOLEAN", int: "BIGINT", type(None): "VOID"}[type(value)])}


def test_paths_to_any_depth(spark):
    values = [
        {"a": {"b": [{"c": [[{"d": "x", "e": 1}]]}, {"c": [[{"f": True}]]}]}, "g": None, "ARRAY": "STRING", "OBJECT": {"VOID": 2}},
        {"messages": [{"role": "u", "content": 'say "a": {[ \\ é'}] * 50 + [{"role": "u", "name": "n"}]},
        {"x": [["p", "q"], ["r"]], "y": "[1,2]", "z": '{"k":1}'},
    ]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "id int, record string").select("id", chat.field_paths(F.col("record")).alias("p"))
    for r in df.collect():
        assert r.p == sorted(f"{p}:{t}" for p, t in paths_of(values[r.id])), r.id


def test_prints_differ_by_nested_paths(spark):
    values = [{"content": "a"}, {"content": ["a"]}, {"content": [{"text": "a"}]}, {"content": {"text": "a"}}, {"content": 1}, {"content": "[1]"}]
    prints = [r.fingerprint for r in chat.canonical_turns(spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "id int, record string")).orderBy("id").collect()]
    assert prints[0] == prints[5] and len(set(prints)) == 5


def test_no_text_is_lost(spark):
    q, a = {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}
    got = read(
        spark,
        {"instruction": "i", "output": "o", "input": "c", "history": [["q", "a"], ["r", "b"]]},
        {"messages": [q, {"role": "assistant", "content": "a", "text": "b"}]},
        {"messages": [q, {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}]}, {"role": "assistant", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
        {"data": {"messages": [q, a]}, "id": 3},
        {"messages": [q, a], "topic": "said nowhere"},
        {"prompt": "other", "messages": [q, a]},
        {"instruction": "i", "output": "o", "history": [["q", "a", "third"]]},
        {"instruction": "i", "output": "o", "history": []},
        {"messages": [{"role": "user", "content": [{"type": "image", "url": "u"}]}, a]},
        '{"question": "q", "answer": "a", "answer": "b"}',
        {"messages": [None, q]},
        {"messages": [{"role": "user", "from": "human", "content": "q"}]},
        {"question": "q", "answer": "a", "data": {"deep": {"text": "t"}}},
        {"question": "q", "answer": "a", "meta": {"deep": {"text": "t"}}, "score": 0.5, "good": True},
        {"messages": [{"role": None, "content": None}]},
        {"system": "s", "instruction": "i", "output": "o"},
    )
    assert got[0] == ("instruction_input_history", [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "b"), ("user", "i\n\nc"), ("assistant", "o")])
    assert got[3] == ("messages_parts", [("user", "q"), ("assistant", "ab")]) and got[4] == ("nested_messages", [("user", "q"), ("assistant", "a")])
    for i in (1, 5, 6, 7, 10, 11, 12, 13):
        assert got[i] == (None, None), i
    assert got[2][0] == "messages" and json.loads(got[2][1][1][1])[1] == {"type": "text", "text": "b"}
    assert got[9][0] == "messages" and json.loads(got[9][1][0][1]) == [{"type": "image", "url": "u"}]
    assert got[8] == ("instruction_history", [("user", "i"), ("assistant", "o")]) and got[14] == ("question", [("user", "q"), ("assistant", "a")])
    assert got[15] == ("messages", [("", "")]) and got[16] == ("instruction", [("system", "s"), ("user", "i"), ("assistant", "o")])


def test_the_query_reaches_all_kinds(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    pair = spark.range(1_000_000, 1_000_200).select(F.col("id").alias("conv_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("turn"))
    pair = pair.select("conv_id", F.col("turn").cast(rows.schema["turn"].dataType), F.when(F.col("turn") == 0, "user").otherwise("assistant").alias("role"), F.when(F.col("conv_id") % 3 == 0, "a\n\nb\n\n\n\nc").when(F.col("conv_id") % 3 == 1, "a\n\n").otherwise("[é]\\ \"").alias("text"))
    led = pair.where("turn = 0").select((F.col("conv_id") + 1000).alias("conv_id"), F.explode(F.array(*[F.struct(F.lit(i).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(r).alias("role"), F.lit(t).alias("text")) for i, (r, t) in enumerate([("system", "s"), ("user", "u"), ("assistant", "")])])).alias("x")).select("conv_id", "x.*")
    rows = rows.unionByName(pair).unionByName(led)
    got = chat.canonical_turns(chat.conversation_records(rows)).cache()
    assert got.where("layout is null").count() == 0
    # the two that are left need an input beside a history; lists of these kinds hold any conversation
    assert {r.layout for r in got.select("layout").distinct().collect()} == {x.name for x in chat.LAYOUTS} - {"instruction_input_history"}
    alike = lambda df, role: df.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(role, "text"))).alias("t"))
    known = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in chat.ROLES.items() for x in p]), F.col("role")), F.coalesce("role", F.lit(""))).alias("role")
    back = alike(got.select("conv_id", F.explode("turns").alias("m")).select("conv_id", F.col("m.role").alias("role"), F.col("m.text").alias("text")), F.col("role"))
    want = alike(rows.withColumn("text", F.coalesce("text", F.lit(""))), known)
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


@pytest.mark.parametrize("n", [30_000_000])
def test_very_long_texts_and_many_turns(spark, n):
    one = spark.range(1).select(F.concat(F.lit('{"messages":[{"role":"assistant","content":"'), F.repeat(F.lit('ab\\n"'.replace('"', '\\"')), n // 6), F.lit('"}]}')).alias("record"))
    r = chat.canonical_turns(one).select("layout", F.char_length(F.get("turns", F.lit(0))["text"]).alias("n")).first()
    assert (r.layout, r.n) == ("messages", n // 6 * 4)
    many = spark.range(1).select(F.concat(F.lit('{"turns":['), F.repeat(F.lit('{"role":"user","text":"t"},'), 700_000), F.lit('{"role":"user","text":"t"}]}')).alias("record"))
    r = chat.canonical_turns(many).select("layout", F.size("turns").alias("n")).first()
    assert (r.layout, r.n) == ("turns", 700_001)


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in chat.op10_chat(spark, str(tmp_path)).collect()] == [-1]
