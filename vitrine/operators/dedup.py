"""Deduplication: the first row of a key by an explicit order, or its best row by completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import squeeze
from ..schemas import ORDER_FIELDS, STORE_COLUMNS
from ..shared import Watch


def keep_first(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """D1-D4, D7. The first row of each key. row_number() = 1 is limited by group before the shuffle."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def fold(name: str) -> Column:
    """Lower case, squeezed, null as empty."""
    return F.coalesce(squeeze(F.lower(F.trim(F.col(name)))), F.lit(""))


def location_keys(*, url_fallback: bool) -> list[Column]:
    """D3, and with the fallback D2: network, city and address; rows without both count by url."""
    keys = [fold("network"), fold("city"), fold("address")]
    return [*keys, F.when((fold("city") == "") & (fold("address") == ""), fold("source_url")).otherwise("")] if url_fallback else keys


def candidate_keys() -> list[Column]:
    """D4. Address, city and coordinates as text."""
    return [F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))) for c in ("address", "city")] + [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in ("lat", "lng", "coords")]


def as_text(name: str) -> Column:
    """The value as text; null and zero are empty."""
    c = F.col(name)
    return F.when(c == 0, "").otherwise(F.coalesce(c.cast("string"), F.lit(""))) if name in ("latitude", "longitude") else F.coalesce(c, F.lit(""))


def completeness(columns: list[str] = ORDER_FIELDS) -> Column:
    """G6. How many of the columns hold something."""
    return sum((F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1).otherwise(0) for c in columns), F.lit(0)).cast("long")


def best_row(df: DataFrame, keys: list[str], order: list[Column], watch: Watch | None = None) -> DataFrame:
    """The row of each key that is greatest by the order. Combines before the shuffle: one row a key and partition is sent.

    watch: sees the rows that go (removed) and the keys whose rows differ in their business fields (conflicts), in the same grouping.
    """
    best = F.max_by(F.struct("*"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("__row")
    if watch is None:
        return df.groupBy(*keys).agg(best).select("__row.*")
    picked = df.groupBy(*keys).agg(best, *copies())
    return watch.on(picked, removed=F.sum("duplicates"), conflicts=F.count_if("conflicting")).select("__row.*")


def preference() -> list[Column]:
    """D6. Completeness, then all fields as text."""
    return [completeness(), *[as_text(c) for c in [*ORDER_FIELDS, "stable_key"]]]


def keep_best(df: DataFrame, ordinal: Column | None = None) -> DataFrame:
    """D6. The richest row of each stable_key; full ties: the last by the ordinal, or by collected_at."""
    return best_row(df, ["stable_key"], [*preference(), F.col("collected_at") if ordinal is None else ordinal])


def keep_best_map(df: DataFrame, ordinal: Column | None = None, watch: Watch | None = None) -> DataFrame:
    """D5. As keep_best, longer addresses before field order."""
    business = [c for c in STORE_COLUMNS if c != "collected_at"]
    order = [completeness(business), F.char_length(F.coalesce("address", F.lit(""))), *[as_text(c) for c in business]]
    return best_row(df, ["stable_key"], [*order, F.col("collected_at") if ordinal is None else ordinal], watch)


def copies() -> list[Column]:
    """Of the rows of a key: how many are too many, and whether their business fields differ."""
    payload = F.to_json(F.struct(*[c for c in STORE_COLUMNS if c != "collected_at"]))
    return [(F.count("*") - 1).alias("duplicates"), (F.min(payload) != F.max(payload)).alias("conflicting")]


def conflicts(df: DataFrame) -> DataFrame:
    """D5. (stable_key, duplicates, conflicting) of keys with more than one row; conflicting: their business fields differ."""
    return df.groupBy("stable_key").agg(*copies()).where("duplicates > 0")
