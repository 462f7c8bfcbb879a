"""Entropy spans by every window of every run of every class, at the real thresholds, both ways."""

import math
import random
from collections import Counter

import duckdb

from vitrine.llm import secrets

SF = "/root/testdata/sf0.01"
HEX, LETTERS = "0123456789abcdefABCDEF", "abcdefghijklmnopqrstuvwxyz"
ALNUM = "0123456789" + LETTERS + LETTERS.upper()
KINDS = [(set(HEX), 3.0), (set(ALNUM), 3.7), (set(ALNUM + "+/_=-"), 3.8)]
DIGEST = "9F86D081884C7D659A2FEAA0C55AD015"


def slow(text):
    marked = set()  # places i so that i - 1 and i are in one span, or touch there
    for chars, bits in KINDS:
        at = 0
        while at < len(text):
            end = at
            while end < len(text) and text[end] in chars:
                end += 1
            run = text[at:end]
            if end - at >= 20 and not any(p.fullmatch(run) for p in secrets.ALLOW):
                for i in range(at, end - 19):
                    h = -sum(c / 20 * math.log2(c / 20) for c in Counter(text[i : i + 20]).values())
                    if h >= bits - 1e-9:
                        marked.update(range(i, i + 20))
            at = max(end, at + 1)
    spans = []
    for i in sorted(marked):
        if spans and i == spans[-1][1]:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return [tuple(x) for x in spans]


def fast(text):
    return [(a, b) for a, k, b in secrets.scan(text) if k == 3]


def test_runs_inside_wider_ones():
    for lead in ("", "key=", "sha-", "example/", "a/b-"):
        assert fast(lead + DIGEST) == [(len(lead), len(lead) + 32)], lead
    token = "qL8vX2mNp4RtY7wZc1KdB9sJ"
    assert fast("example/" + token) == [(8, 8 + len(token))] and fast("example" + token) == []
    assert fast("123e4567-e89b-12d3-a456-426614174000") == [] and fast("src/main/java/org/thing1/part2") == []
    assert fast("plain words only, and-some-longer-hyphenated-words") == [] and fast("key=12345678901234567890123") == []


def test_against_every_window():
    rng, some = random.Random(2), 0
    texts = [t or "" for (t,) in duckdb.connect().execute(f"select text from '{SF}/documents.parquet'").fetchall()]
    parts = [HEX, ALNUM, ALNUM + "+/_=-", LETTERS, "0123456789", "=/-", " ."]
    for _ in range(3000):
        texts.append("".join("".join(rng.choices(rng.choice(parts), k=rng.randrange(1, 40))) for _ in range(rng.randrange(1, 6))))
    for t in texts:
        want = slow(t)
        assert fast(t) == want, t
        some += len(want)
    assert some > 1000


def test_query_over_nulls_and_no_documents(spark, tmp_path):
    for i, rows in enumerate(([(1, None), (None, ""), (2, "key=" + DIGEST), (2, "key=" + DIGEST)], [])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/{i}/documents.parquet")
        got = secrets.op2_secrets(spark, f"{tmp_path}/{i}").collect()
        assert sorted((r.doc_id or 0, r.spans) for r in got) == sorted((d or 0, "entropy:4:36" if t else "") for d, t in rows)
    assert got == []
