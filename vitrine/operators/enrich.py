"""Enrichment joins: lookups, contexts and fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.places import bare_token, page_address, sanitize_location
from ..functions.worktime import clean_work_time


def fill_region(cities: DataFrame, lookup: DataFrame) -> DataFrame:
    """X1. cities (region_id, region_name, ...) with blank region names filled from lookup (id, name)."""
    l = lookup.select(F.col("id").alias("region_id"), F.col("name").alias("__name"))
    return cities.join(l, "region_id", "left").withColumn("region_name", F.when(F.trim(F.coalesce("region_name", F.lit(""))) != "", F.col("region_name")).otherwise(F.col("__name"))).drop("__name")


def first_context(rows: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """D7. The first row's columns of each key, by the order; combines before the shuffle."""
    s = F.min(F.struct(*order, *[F.col(c).alias(f"v_{c}") for c in columns])).alias("s")
    return rows.groupBy(key).agg(s).select(key, *[F.col(f"s.v_{c}").alias(c) for c in columns])


def backfill(city: Column, region: Column, context_city: Column, context_region: Column) -> Column:
    """X4. (city, region) completed from the context unless the two contradict each other."""
    blank = lambda c: F.when(F.trim(c) != "", c)
    c, r, cc, cr = map(blank, (city, region, context_city, context_region))
    differ = lambda a, b: F.coalesce(bare_token(a) != bare_token(b), F.lit(False)) & a.isNotNull() & b.isNotNull()
    wrong_city, wrong_region = differ(c, cc), differ(r, cr)
    new_city = F.when(wrong_city | wrong_region, c).otherwise(F.coalesce(c, cc))
    new_region = F.when(wrong_city | wrong_region, r).otherwise(F.coalesce(r, cr))
    return F.struct(new_city.alias("city"), new_region.alias("region"))


def with_detail(summaries: DataFrame, details: DataFrame, key: str = "url") -> DataFrame:
    """X5, H13, H14. Each summary with its detail page where one was read (outcome parsed), else the summary alone (partial), if it says anything; others are skipped.

    Both have key, city, region, address, work_time, phone, store_format; details may add more columns. Of a parsed row, address, work_time,
    phone and store_format come from the details and, field by field, from the summary where these say nothing; city and
    region are the details', completed from the summary by X4.
    """
    fields = ["address", "work_time", "phone", "store_format"]
    d = details.withColumn("__hit", F.lit(True)).withColumnsRenamed({c: f"__{c}" for c in ("city", "region", *fields)})
    j = summaries.join(d, key, "left")
    hit = F.coalesce("__hit", F.lit(False))
    text = lambda c: F.when(F.trim(c) != "", c)
    clean = {"address": page_address, "work_time": clean_work_time, "phone": lambda c: c, "store_format": lambda c: c}
    merged = {c: clean[c](F.coalesce(text(F.col(f"__{c}")), text(F.col(c)))) for c in fields}  # without a hit the first is null
    city, region = sanitize_location(F.col("city")), sanitize_location(F.col("region"))
    j = j.withColumn("__place", F.when(hit, backfill(sanitize_location(F.col("__city")), sanitize_location(F.col("__region")), city, region)).otherwise(F.struct(city.alias("city"), region.alias("region"))))
    j = j.withColumns(merged | {"city": F.col("__place.city"), "region": F.col("__place.region")})
    some = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("city", "region", *fields)]).isNotNull()
    return j.withColumn("outcome", F.when(hit, "parsed").when(some, "partial").otherwise("skipped")).drop("__hit", "__place", *[f"__{c}" for c in ("city", "region", *fields)])
