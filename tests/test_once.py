"""What a query computes once, and how many jobs its rounds take."""

import uuid

from pyspark.sql import functions as F

from vitrine.plans import catalog
from vitrine.sources import crawl, snapshot


def test_versions_key_each_store_once(spark, monkeypatch):
    sf, keyed, seen = "/root/testdata/sf0.001", catalog.keyed, spark.sparkContext.accumulator(0)

    def count(k):
        seen.add(1)
        return k

    monkeypatch.setattr(catalog, "keyed", lambda s, d: keyed(s, d).withColumn("c_custkey", F.udf(count, "long")("c_custkey").alias("k")))
    assert catalog.diff_versions(spark, sf).count() > 0
    assert seen.value == spark.read.parquet(f"{sf}/customer.parquet").count()


def test_buckets_hold_few_rows():
    assert snapshot.layout(900_000) == (32, 9) and snapshot.layout(5_400_000)[1] == 54 and snapshot.layout(5) == (1, 1)


def test_queues_go_by_rounds(spark):
    """Queues that are full or have ended leave; cycles, pages without links, links to nothing, nulls and a chain that takes every round."""
    tree = {f"t{i}": [f"t{i}", f"t{2 * i + 1}", f"t{2 * i + 2}", f"t{2 * i + 1}"] for i in range(200)}
    chain = {f"c{i}": [f"c{i + 1}"] for i in range(30)}
    links = tree | chain | {"a": ["b", "gone", None], "b": ["a", "b", "x"], "x": [], "n": None}
    starts = [*links, "alone", None, "a"]

    def queue(start, most):
        out, taken = [start], 0
        while taken < len(out):
            for x in links.get(out[taken]) or []:
                if x not in out and len(out) < most:
                    out.append(x)
            taken += 1
        return out

    df = spark.createDataFrame(list(links.items()), "url string, links array<string>")
    s = spark.createDataFrame([(x,) for x in starts], "start string")
    for most in (1, 2, 20):
        got = {r.start: r.queue for r in crawl.queues(s, df, most).collect()}
        assert got == {x: queue(x, most) for x in starts if x is not None}
    assert crawl.queues(s.where("false"), df, 20).count() == 0
    # a full queue ends the work: few jobs, where there were `most` steps of several each
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "queues of a tree")
    try:
        assert crawl.queues(spark.createDataFrame([("t0",)], "start string"), spark.createDataFrame(list(tree.items()), "url string, links array<string>"), 20).first().queue == queue("t0", 20)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        assert jobs < 45, jobs
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
