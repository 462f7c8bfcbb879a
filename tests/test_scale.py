"""Steps that cost far more than their rows weigh: over many tasks, and each value computed once."""

import re

from pyspark.sql import functions as F

from vitrine import shared
from vitrine.functions import text
from vitrine.plans import views


def test_customers_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    spark.range(6000).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    sizes = lambda: [r["count"] for r in views.customers(spark, str(tmp_path)).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes()) == 6 and sum(sizes()) == 6000  # one a thousand rows, while there are cores
    monkeypatch.setattr(shared, "MOST_ROWS", 300)
    assert len(sizes()) == 20 and max(sizes()) < 450 and sum(sizes()) == 6000  # by rows, where these are many
    spark.range(10).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/few/customer.parquet")
    assert views.customers(spark, f"{tmp_path}/few").count() == 10


def test_classes_of_tokens_take_every_other_character(spark):
    """NO_TOKEN and NO_BARE, said by ranges, are the complements that the tokens name."""
    points = [chr(i) for i in [*range(0x3000), *range(0xD700, 0xD800), *range(0xE000, 0xE100), 0xFFFD, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]]
    df = spark.createDataFrame([("".join(points),)], "t string").select(F.regexp_replace("t", text.NO_TOKEN, ""), F.regexp_replace("t", text.NO_BARE, ""))
    assert tuple(df.first()) == tuple(re.sub(p, "", "".join(points)) for p in ("[^0-9a-zа-яё]+", "[^0-9a-zа-я]+"))


def test_tokens_of_placeholders_and_odd_space(spark):
    given = [None, "", " ", "N/A", " NaN ,; ", "none.", "x none", "-", "- ;", "\x1cnull\x1f", "nullnull", "Ёлка, №5　Ω", "İΣ"]
    want = ["", "", "", "", "", "none", "xnone", "", "", "", "nullnull", "ёлка5", "i"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, t string").select("i", text.text_token(F.col("t")).alias("k"))
    assert [r.k for r in df.orderBy("i").collect()] == want


def test_a_fragment_is_cleaned_once(spark):
    plan = spark.createDataFrame([("a, ул. 1", "a")], "address string, city string").select(text.strip_city(F.col("address"), F.col("city")).alias("x"))
    assert plan.first().x == "ул. 1"
    assert plan._jdf.queryExecution().executedPlan().toString().count("regexp_replace") < 10
