"""Vectors wider than the code."""

import pytest
from pyspark.sql import functions as F

from vitrine.llm import topk


def test_wide_vectors_fail(spark):
    df = spark.createDataFrame([(1, [1.0] * 64), (2, [1.0, -1.0]), (3, None), (4, [0.0] * 64 + [1.0])], "id int, v array<double>")
    code = df.select("id", topk.sign_code(F.col("v")).alias("c"))
    assert {r.id: r.c for r in code.where("id < 4").collect()} == {1: -1, 2: 1, 3: None}
    with pytest.raises(Exception, match="more than 64 components"):
        code.collect()
