import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from vitrine.llm import suffix


def brute(rows, w=200):
    places = defaultdict(set)
    for k, (_, t) in enumerate(rows):
        b = (t or "").encode()
        for p in range(len(b) - w + 1):
            places[b[p : p + w]].add((k, p))
    out = []
    for k, (i, t) in enumerate(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - w + 1):
            if len(places[b[p : p + w]]) > 1:
                gone[p : p + w] = True
        edges = np.diff(np.r_[0, gone.astype(int), 0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", range(4))
def test_suffix_array_and_prefixes(kind):
    r = random.Random(kind)
    t = bytes([r.choice(b"abcde"[: kind + 2]) for _ in range(600)]) if kind < 3 else b"ab" * 200 + b"a" * 150 + b"ba" * 20
    a = np.frombuffer(t, np.uint8)
    sa = suffix.suffix_array(a, 10_000)
    want = sorted(range(len(t)), key=lambda i: t[i:])
    assert sa.tolist() == want
    lcp = suffix.common_prefixes(sa, suffix.words8(a), 10_000).tolist()
    for k in range(1, len(t)):
        x, y = t[want[k - 1] :], t[want[k] :]
        n = next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))
        assert lcp[k] == n


def fixture():
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghijklmnopé") for _ in range(r.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, line = text(80), text(45)
    rows = [(i, text(60) + (" " + shared[r.randint(0, 50) : r.randint(250, 400)] if i % 3 else "") + text(r.randint(0, 90))) for i in range(40)]
    rows += [(100 + i, line + text(30)) for i in range(25)]
    rows += [(200, "a" * 700), (201, "ab" * 300), (202, line[:260] * 3), (203, ""), (204, None), (205, "x" * 199), (206, "x" * 200), (207, rows[3][1]), (207, rows[4][1]), (208, rows[5][1]), (208, rows[5][1])]
    return rows


@pytest.mark.parametrize("hot", [suffix.HOT_BYTES, 5, 8000])
def test_against_brute_force(spark, hot):
    rows = fixture()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string")
    got = sorted(map(tuple, suffix.remove_repeats(df, hot=hot).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
