"""Rows that can't meet are left out before a join, and none that can."""

from vitrine.llm import common


def test_no_row_that_meets_is_left_out(spark, monkeypatch):
    df = spark.range(20_000).withColumnRenamed("id", "a.b").withColumn("k", common.F.expr("if(`a.b` = 3, null, `a.b` - 10000)"))
    few = spark.range(-10_000, 10_000, 40).withColumnRenamed("id", "k")
    for most in (1 << 26, 4096):
        monkeypatch.setattr(common, "MAX_BITS", most)
        got = common.possible(df, "k", few)
        assert got.columns == ["a.b", "k", "__maybe"] and got.count() == 20_000
        true = {r.k for r in got.where("__maybe").collect()}
        assert {r.k for r in few.collect()} <= true and len(true) < (3_500 if most > 4096 else 5_000)
    assert common.likely(df, "k", few.where("false")).count() == 0
    names = spark.createDataFrame([(b"a",), (b"b",), (None,)], "node binary")
    assert {bytes(r.node) for r in common.likely(names, "node", names.where("node = X'61'")).where("node is not null").collect()} >= {b"a"}
