import random

import pytest

from vitrine.llm.common import components


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    r = random.Random(3)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(999, i) for i in range(50)] + [(7, 7)], "random": [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)], "none": []}[shape]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def find(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            up[find(a)] = find(b)
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    for a in got:
        for b in got:
            assert (got[a] == got[b]) == (find(a) == find(b))
