"""The budget may end inside rows that are equal in id, source and size: as many of them are taken as the queue serves."""

from pyspark.sql import functions as F

from vitrine.llm import mixing


def test_budget_ends_inside_equal_rows(spark):
    docs = spark.createDataFrame([(7, "a", 3, str(i)) for i in range(40)] + [(i, "b", 3, "") for i in range(100, 110)], "doc_id long, source string, size long, more string")
    out = mixing.mix(docs).cache()
    assert out.count() == 50 and out.where("taken > 2 * size or taken % size <> 0").isEmpty()
    target = {r["source"]: r["target"] for r in out.select("source", "target").distinct().collect()}
    taken = {r["source"]: r["t"] for r in out.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert all(abs(taken[s] - target[s]) <= 3 for s in target) and sum(taken.values()) <= 225
    assert out.where("source = 'a'").select("taken").distinct().count() == 2
    assert {r["more"] for r in out.where("source = 'a'").collect()} == {str(i) for i in range(40)}


def test_all_is_taken_where_the_budget_does_not_end(spark):
    docs = spark.createDataFrame([(1, None, 4), (None, None, 2), (None, None, 2), (3, None, 0)], "doc_id long, source string, size long")
    taken = sorted((r["size"], r["taken"]) for r in mixing.mix(docs, share=2.0).collect())
    assert taken == [(0, 0), (2, 4), (2, 4), (4, 8)]
