"""The stage near_dedup on rows that repeat an id or have none."""

import corpus_pipeline
from vitrine.llm import minhash

LONG = " ".join(f"w{i}" for i in range(60))
NEAR = LONG + " end"
OTHER = " ".join(f"v{i}" for i in range(60))
THIRD = " ".join(f"u{i}" for i in range(60))


def kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = corpus_pipeline.drop_near_copies(spark, df, "")
    assert out.columns == df.columns
    return sorted(map(tuple, out.collect()), key=str)


def test_repeated_rows(spark):
    """One row of each group: whole repeats, a near copy under the same id, and an id whose one text is another's copy."""
    got = kept(spark, [(1, LONG, "a")] * 3 + [(1, NEAR, "a"), (2, LONG, "b"), (2, OTHER, "b"), (3, "", "c"), (3, "", "c"), (4, None, "c"), (5, THIRD, "d")])
    assert len(got) == 5 and [r[0] for r in got] == [1, 2, 3, 4, 5]
    assert got[0][1] in (LONG, NEAR) and got[1:] == [(2, OTHER, "b"), (3, "", "c"), (4, None, "c"), (5, THIRD, "d")]


def test_null_ids(spark):
    """Rows without an id link by text; one stays where no copy has an id, and all that have no shingles stay."""
    rows = [(None, LONG, "a"), (7, NEAR, "a"), (None, OTHER, "b"), (None, OTHER, "b"), (None, OTHER + " end", "b"), (None, THIRD, "c"), (None, " ", "d"), (None, None, "d"), (8, "short", "e")]
    got = kept(spark, rows)
    other = [r for r in got if r[2] == "b"]
    assert len(other) == 1 and other[0][0] is None and other[0][1].startswith(OTHER)
    assert [r for r in got if r[2] != "b"] == sorted([(7, NEAR, "a"), (None, THIRD, "c"), (None, " ", "d"), (None, None, "d"), (8, "short", "e")], key=str)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert found.count() == len(rows) and found.where("kept is null").count() == 0
    nameless = sorted((r.n_shingles, r.component_id or 0, r.kept) for r in found.where("doc_id is null").collect())
    assert nameless.count((0, 0, True)) == 2 and (56, 7, False) in nameless and sum(r[2] for r in nameless) == 4
