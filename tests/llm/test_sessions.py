"""Sessions against a fold by hand over each client's clicks."""

import hashlib
import random
from collections import defaultdict
from datetime import datetime, timedelta

import duckdb
import pytest

from vitrine.llm import sessions as S

SF = "/root/testdata/sf0.01"
SCHEMA = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double"
T0 = datetime(2024, 3, 31, 0, 30)
MINUTE = 60_000_000


def us(t):
    return (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def by_hand(clicks):
    kept, late = defaultdict(list), defaultdict(list)
    for c in {c[0]: c for c in clicks if c[0] is not None and c[3] is not None and c[1] is not None}.values():
        (late if c[2] is not None and us(c[2]) - us(c[1]) > 15 * MINUTE else kept)[c[3]].append(c)
    out = []
    for client, rows in kept.items():
        made, first, before = [], None, None
        for c in sorted(rows, key=lambda c: (c[1], c[0])):
            t, final = us(c[1]), c[4] in ("purchase", "signup") and c[5] is not None and c[5] >= 60
            why = before and ("end" if before[1] else "gap" if t - before[0] >= 15 * MINUTE else "length" if t - first > 60 * MINUTE else None)
            if before is None or why:
                if made:
                    made[-1]["closed_by"] = why
                made.append({"client_id": client, "session_id": c[0], "start_us": t, "n_late": 0, "value_cents": 0, "ids": []})
                first = t
            s, before = made[-1], (t, final)
            s["end_us"], s["closed_by"] = t, "end" if final else "none"
            s["ids"].append(c[0])
            s["value_cents"] += int((100 * c[5] + 0.5) // 1) if c[5] is not None else 0
        for c in late[client]:
            here = [s for s in made if s["start_us"] <= us(c[1])]
            if here:
                here[-1]["n_late"] += 1
        for s in made:
            ids = s.pop("ids")
            s |= {"n_clicks": len(ids), "path_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()}
            out.append(s)
    return sorted(out, key=lambda s: s["session_id"])


def run(spark, clicks, extra=""):
    df = spark.createDataFrame([(*c, *(["x"] if extra else [])) for c in clicks], SCHEMA + extra).repartition(3)
    return sorted((r.asDict() for r in S.sessions(df).collect()), key=lambda s: s["session_id"])


def some(seed, n, clients, *, step, final=0.1, late=0.1):
    rng, out, at = random.Random(seed), [], defaultdict(lambda: T0)
    for i in range(n):
        client = rng.choice(clients)
        at[client] += rng.choice([timedelta(0), timedelta(seconds=rng.randrange(1, step)), timedelta(minutes=rng.choice([15, 14, 1, 60, 59]))] if rng.random() < 0.3 else [timedelta(seconds=rng.randrange(step))])
        delay = timedelta(minutes=rng.choice([16, 400])) if rng.random() < late else timedelta(minutes=rng.choice([0, 15]))
        kind = rng.choice(["purchase", "signup"]) if rng.random() < final else rng.choice(["view", None, "purchase"])
        out.append((1000 * n - i if rng.random() < 0.2 else i, at[client], at[client] + delay, client, kind, rng.choice([60.0, 75.126]) if kind and rng.random() < final else rng.choice([None, 59.99, -3.005, 1.0])))
    return out


@pytest.mark.parametrize(("seed", "step", "final"), [(1, 300, 0.3), (2, 800, 0.02), (3, 20, 0.0), (4, 899, 0.0)])
def test_random_clicks(spark, seed, step, final):
    clicks = some(seed, 400, [1, 2, 2, 2, 2, -5], step=step, final=final)
    assert run(spark, clicks + clicks[:50]) == by_hand(clicks)


def test_long_chain_ties_and_edges(spark):
    """Hours of clicks without a gap or final one; times exactly 15 and 60 minutes apart; equal times around a final click."""
    chain = [(i, T0 + timedelta(minutes=7 * i), T0 + timedelta(minutes=7 * i), 1, "view", 1.0) for i in range(300)]
    exact = [(1000 + i, T0 + timedelta(minutes=m), None, 2, None, None) for i, m in enumerate((0, 14, 28, 42, 56, 60, 60, 61, 76, 91))]
    tie = [(2000 + i, T0, T0, 3, "signup", 60.0) for i in range(4)] + [(2010, T0, T0 + timedelta(hours=1), 3, None, None)]
    early = [(3000, T0, T0 + timedelta(hours=2), 4, None, 1.0), (3001, T0 + timedelta(hours=9), T0 + timedelta(hours=9), 4, None, 1.0), (3002, T0 + timedelta(days=9), T0 + timedelta(days=20), 4, None, 1.0)]
    got = run(spark, chain + exact + tie + early)
    assert got == by_hand(chain + exact + tie + early)
    assert sum(s["closed_by"] == "length" for s in got if s["client_id"] == 1) == 33


def test_nulls_and_clashing_names(spark):
    rows = [(None, T0, T0, 1, "view", 1.0), (1, None, T0, 1, "view", 1.0), (2, T0, T0, None, "view", 1.0), (3, T0, None, 1, None, float("nan")), (4, T0, T0, 1, "signup", float("inf"))]
    got = run(spark, rows, ", run string")
    assert [(s["session_id"], s["n_clicks"], s["value_cents"], s["closed_by"]) for s in got] == [(3, 2, 0, "end")]
    assert run(spark, []) == []


def test_repeats_that_differ_count_once(spark):
    rows = [(1, T0 + timedelta(minutes=5), T0, 1, "view", 1.0), (1, T0, T0, 2, "view", 2.0)]
    assert [(s["client_id"], s["value_cents"]) for s in run(spark, rows)] == [(2, 200)]


def test_zone_does_not_matter(spark):
    clicks = some(7, 60, [1, 2], step=600)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # the night of a change of clocks
        assert run(spark, clicks) == by_hand(clicks)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_whole_table(spark):
    con = duckdb.connect()
    con.execute(f"create view clicks as select * from '{SF}/clicks.parquet'")
    want = con.execute(S.ORACLE)
    names = [d[0] for d in want.description]
    got = S.op11_sessions(spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_refuses_a_gap_over_the_length(spark):
    with pytest.raises(ValueError):
        S.sessions(spark.createDataFrame([], SCHEMA), gap=2, length=1)
