"""Nearest neighbours against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest

from vitrine.llm import neighbours as N

SF = "/root/testdata/sf0.01"


def sequential(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += float(x) * float(y)
    return total


def brute(rows, queries, k):
    return {q: sorted(((-sequential(v, w), i) for i, w in rows.items() if i != q))[:k] for q, v in queries.items()}


def run(spark, rows, queries, k, kind="array<float>", **more):
    a, b = spark.createDataFrame(rows, f"id long, vector {kind}"), spark.createDataFrame(queries, f"id long, vector {kind}")
    out = defaultdict(list)
    for r in sorted(N.nearest(a, b, k, **more).collect(), key=lambda r: (r.query_id, r["rank"])):
        out[r.query_id].append((-r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return dict(out)


def vectors(n, dim, seed, kind=np.float32):
    x = np.random.default_rng(seed).standard_normal((n, dim)).astype(kind)
    return [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]


def test_recall_over_the_whole_table(spark):
    got = defaultdict(list)
    for r in N.op13_neighbours(spark, SF).collect():
        got[r.query_id].append((-r.score, r.vec_id))
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    want = brute(rows, {i: v for i, v in rows.items() if i % 20 == 0}, 20)
    assert got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)


def test_many_cells_of_unequal_norms(spark):
    """Clusters whose cells a query needn't see: the measure is exact, recall high, and not all cells are asked."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 8)) * 10
    rows = [(i, [float(x) for x in (centres[i % 20] + rng.standard_normal(8)) * (1 + i % 3)]) for i in range(1000)]
    queries = [r for r in rows if r[0] % 20 == 0]
    got, want = run(spark, rows, queries, 5, "array<double>", leaf_rows=40, part_rows=16, query_rows=7), brute(dict(rows), dict(queries), 5)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)


def test_the_test_stops(spark):
    """Well separated clusters: cells of other clusters are not asked for."""
    space = N.Space(4, 1.0)
    low = np.array([[0.0] * 12, [50.0] * 12])
    import pyarrow as pa

    q = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([[1.0, 0, 0, 0]]), pa.array([0.9])], names=["q", "vector", "kth"])
    ask = lambda skip: [c for b in N._asks(space, low, low + 1, np.array([7, 8]), skip, 1, N.stop_factor())(iter([q])) for c in b.column(3).to_pylist()]
    assert ask(1) == []
    none = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([[1.0, 0, 0, 0]]), pa.array([None], pa.float64())], names=["q", "vector", "kth"])
    assert [c for b in N._asks(space, low, low + 1, np.array([7, 8]), 1, 1, N.stop_factor())(iter([none])) for c in b.column(3).to_pylist()] == [8]


def test_copies_ties_and_few_rows(spark):
    """A third of the rows share a vector, whole numbers tie; fewer than k candidates come out all."""
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(100)] + [(100 + i, [float(i % 3), float(i % 2), 1.0]) for i in range(200)]
    queries = [r for r in rows if r[0] % 20 == 0]
    assert run(spark, rows, queries, 4) == brute(dict(rows), dict(queries), 4)
    assert run(spark, rows[98:104], rows[98:104], 20) == brute(dict(rows[98:104]), dict(rows[98:104]), 20)
    assert run(spark, rows[:1], rows[:1], 3) == {}


def test_what_takes_no_part(spark):
    bad = [(None, [1.0, 0.0]), (90, None), (91, [0.0, 0.0]), (92, [None, 1.0]), (93, [math.nan, 1.0]), (94, [math.inf, 1.0]), (95, [1.0, 2.0, 3.0]), (96, [])]
    good = vectors(30, 2, 3)
    assert run(spark, good + bad + good, good[:3] + bad + good[:3], 5) == brute(dict(good), dict(good[:3]), 5)
    assert run(spark, [], good, 5) == {}
    assert run(spark, good, [], 5) == {}
    assert run(spark, bad[:-2], good, 5) == {}


@pytest.mark.parametrize(("x", "p"), [(21.026, 0.95), (18.549, 0.9), (11.340, 0.5)])
def test_chi_square_with_12_degrees(x, p):
    assert abs(N.chi_square(x) - p) < 1e-3
    assert abs(N.stop_factor(p) - x) < 1e-2
