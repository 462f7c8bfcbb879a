"""Importance resampling against a version by hand."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest

from vitrine.llm import resampling as R

SF = "/root/testdata/sf0.01"


def grams(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)], len(w)


def by_hand(docs, target, n, buckets):
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(at(f) for _, x in docs for f in grams(x, n)[0]), Counter(at(f) for x in target for f in grams(x, n)[0])
    gain = {b: math.floor(1000 * math.log(float((t[b] + 1) * (s.total() + buckets)) / float((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)}
    out = []
    for i, x in docs:
        g, w = grams(x, n)
        weight = sum(gain[at(f)] for f in g)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(g), w, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[2] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = {id(r): k for k, r in enumerate(able[: len(able) * 10 // 100], 1)}
    return [(i, f, weight, score, drawn.get(id(r))) for r in out for i, f, _, weight, score in [r]]


def run(spark, docs, target, n=1, buckets=100, schema="doc_id long, text string", extra=()):
    d = spark.createDataFrame([(*r, *extra) for r in docs], schema)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    return [tuple(r) for r in R.draw(R.importance(d, t, n=n, buckets=buckets)).select("doc_id", "n_features", "weight", "score", "rank").collect()]


order = lambda rows: sorted(rows, key=str)
DOCS = [(i, " ".join(f"w{(i * j) % 37}É{j % 3}" for j in range(i % 45))) for i in range(120)]
TARGET = ["W1é2 w3É0", None, "", "w5É1 " * 30]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_by_hand(spark, n):
    assert order(run(spark, DOCS, TARGET, n)) == order(by_hand(DOCS, TARGET, n, 100))


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BYTES", 500)
    assert order(run(spark, DOCS, TARGET)) == order(by_hand(DOCS, TARGET, 1, 100))


def test_nulls_repeats_long_and_clashing(spark):
    docs = [(None, "ab " * 25), (1, None), (1, "x y"), (2, ""), (3, "a" * 300_000), (4, "b " * 200_000), *[(5, "c d " * 15)] * 12]
    got = run(spark, docs, TARGET, schema="doc_id long, text string, block string, weight int", extra=("z", 1))
    assert order(got) == order(by_hand(docs, TARGET, 1, 100))


def test_empty_tables(spark):
    assert run(spark, [], TARGET) == []
    assert order(run(spark, DOCS, [])) == order(by_hand(DOCS, [], 1, 100))


def test_whole_tables(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(R.ORACLE)
    names = [d[0] for d in want.description]
    got = R.op12_resample(spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert order(map(tuple, got.select(*names).collect())) == order(want.fetchall())
