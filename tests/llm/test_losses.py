"""Nothing is lost or overwritten: columns of any name, all list elements, repeated packets, long tables, long and periodic texts."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitrine.llm import chat, media, minhash, mixing, suffix, toxicity
from vitrine.llm.toxicity import OrdinalModel

CLASHING = "doc_id long, text string, source string, size long, target string, taken string, toxic string, grade string, expected_severity string, row string, key string, slot string, range int, __key string, __row string, __node string, __n int"


def clashing(spark, n=12):
    rows = [(i, " ".join(f"w{i % 6}_{k}" for k in range(20 + i % 6)), "ab"[i % 2], 99, "T", "x", "y", "g", "e", "r", "k", "s", 5, "__k", "__r", "__o", 7) for i in range(n)]
    return spark.createDataFrame(rows, CLASHING)


def test_columns_stay(spark):
    docs = clashing(spark)
    names = docs.columns
    own = {tuple(r) for r in docs.collect()}
    model = OrdinalModel({"w0": 9.0}, [0.5], 0.5)
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == names and {tuple(r) for r in clean.collect()} == {r for r in own if "w0_1" not in r[1]}
    once = minhash.keep_one(docs)
    assert once.columns == names and {tuple(r) for r in once.collect()} == {r for r in own if r[0] < 6}
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == names and {tuple(r) for r in mixed.collect()} <= own and mixed.count() > 0
    told = mixing.mix(docs.withColumn("size", F.lit(10)))
    assert told.where("size = 10 and target > 0 and taken <= 20 and key = 'k' and slot = 's' and range = 5 and __key = '__k'").count() == 12


def test_toxicity_stage_keeps_columns(spark, tmp_path):
    docs = clashing(spark)
    spark.createDataFrame([(i, int(i % 2)) for i in range(12)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and {r.toxic for r in out.collect()} <= {"y"}


def test_empty_pipeline(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def turns(spark, *records):
    df = chat.canonical_turns(spark.createDataFrame([(i, r) for i, r in enumerate(records)], "id int, record string"))
    return {r.id: (r.layout, None if r.turns is None else [tuple(t) for t in r.turns]) for r in df.collect()}


def test_chat_all_elements_and_extra_fields(spark):
    m = lambda *x, **more: json.dumps({"messages": list(x)} | more)
    got = turns(
        spark,
        m({"role": "user", "content": "q"}, {"role": "assistant", "value": "kept"}, id=7, meta={"a": [1, {"b": 2}]}),
        m({"from": "human", "text": "q", "weight": 1}, {"role": "assistant", "content": "a", "name": None}),
        m({"role": "user", "content": "q"}, {"role": "assistant", "body": "unknown name"}),
        m({"role": "user", "content": "q"}, "no object"),
        json.dumps({"prompt": "p", "prompt_id": 3, "messages": [{"role": "user", "content": "p"}, {"role": "assistant", "content": "r"}]}),
        json.dumps({"id": "x", "system": "be kind", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}),
        json.dumps({"question": "q", "answer": "a", "id": 1, "source": "s"}),
        json.dumps({"prompt": "p", "completion": "c", "label": True}),
        json.dumps({"system_prompt": "s", "question": "q", "response": "r", "id": 1}),
        json.dumps({"instruction": "i", "input": "", "output": "o", "system": ""}),
        json.dumps({"turns": [{"role": "bot", "text": "t"}], "id": 1}),
        json.dumps({"prompt": "p", "response": ["l", 1]}),
    )
    assert got[0] == ("messages", [("user", "q"), ("assistant", "kept")]) and got[1] == ("messages", [("user", "q"), ("assistant", "a")])
    assert got[2] == (None, None) and got[3] == (None, None)
    assert got[4] == ("messages", [("user", "p"), ("assistant", "r")])
    assert got[5] == ("sharing", [("system", "be kind"), ("user", "q"), ("assistant", "a")])
    assert got[6] == ("question", [("user", "q"), ("assistant", "a")]) and got[7] == ("completion", [("user", "p"), ("assistant", "c")])
    assert got[8] == ("question_system", [("system", "s"), ("user", "q"), ("assistant", "r")]) and got[9] == ("instruction_input", [("user", "i"), ("assistant", "o")])
    assert got[10] == ("turns", [("assistant", "t")]) and got[11] == ("prompt", [("user", "p"), ("assistant", '["l",1]')])


def packets(stream):
    return [stream[i : i + 188] for i in range(0, len(stream), 188)]


def test_repeats_across_other_packets():
    payload = media.pad(random.Random(1).randbytes(448))
    p = packets(media.mux(payload))
    filler = b"\x47\x1f\xff\x10" + b"\xff" * 184
    es = next(i for i, x in enumerate(p) if x[1] & 0x1F == 1 and x[2] == 0 and not x[1] & 0x40)
    d = media.demux(b"".join(p[: es + 1] + [filler, p[es]] + p[es + 1 :]))
    assert d.payload() == payload and d.continuity_errors == 0
    assert media.demux(b"".join(p[:es] + p[es + 1 :])).continuity_errors == 1


def test_long_and_several_tables():
    """An association table of 60 programs spans two packets; two map sections share one packet."""
    pmt = 0x1000
    pat = media._section(0, 1, b"".join((n + 1).to_bytes(2, "big") + (0xE000 | pmt).to_bytes(2, "big") for n in range(60)))
    assert len(pat) > 184
    one = lambda n, pid: media._section(2, n, (0xE000 | pid).to_bytes(2, "big") + b"\xf0\x00" + bytes([6]) + (0xE000 | pid).to_bytes(2, "big") + b"\xf0\x00")
    head = lambda pid, cc, start: b"\x47" + ((0x4000 if start else 0) | pid).to_bytes(2, "big") + bytes([0x10 | cc])
    first = head(0, 0, True) + b"\x00" + pat[:183]
    second = (head(0, 1, False) + pat[183:]).ljust(188, b"\xff")
    maps = (head(pmt, 0, True) + b"\x00" + one(1, 0x100) + one(2, 0x101)).ljust(188, b"\xff")
    d = media.demux(first + second + maps + b"".join(packets(media.mux(media.pad(b"x")))[2:]))
    assert len(d.programs) == 60 and d.programs[1] == {0x100: 6} and d.programs[2] == {0x101: 6} and d.table_errors == 0
    assert d.payload(0x100) == media.pad(b"x")
    assert media.demux(first + maps).table_errors == 1  # cut short


@pytest.mark.parametrize("kind", ["random", "periodic", "mixed"])
def test_pieces_hold_each_window_once(kind, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK_BITS", 11)  # several blocks
    monkeypatch.setattr(suffix, "PIECE", 300)
    r = random.Random(4)
    body = {"random": r.randbytes(9000), "periodic": b"abc" * 3000, "mixed": r.randbytes(2500) + b"z" * 4000 + r.randbytes(300) * 6}[kind]
    t = np.frombuffer(body, np.uint8)
    h, a, n, _ = suffix.pieces(t)
    seen = np.zeros(len(t) - 199, int)
    by = {}
    for v, s, c in zip(h.tolist(), a.tolist(), n.tolist()):
        assert 1 <= c <= 300
        seen[s : s + c] += 1
        for i in range(s, s + c):
            assert by.setdefault(body[i : i + 200], v) == v  # equal windows, equal hash
    assert (seen == 1).all()
