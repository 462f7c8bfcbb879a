"""Differences of two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import compare_url
from ..schemas import CHANGE_SCHEMA, STORE_COLUMNS, TRACKED_FIELDS
from .dedup import preference

RANKS = {"added": 0, "removed": 1, "changed": 2}


def payload(fields: dict[str, Column]) -> Column:
    """C5. JSON of the fields in order of name, nulls left out; nothing left: null."""
    return F.nullif(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])), F.lit("{}"))


def changed_fields() -> Column:
    """C3. Names of the tracked fields that differ, in order; urls are compared by their alias."""
    def value(side: str, f: str) -> Column:
        return F.col(f"{side}.alias") if f == "source_url" else F.col(f"{side}.{f}")

    return F.array_compact(F.array(*[F.when(~value("p", f).eqNullSafe(value("c", f)), F.lit(f)) for f in TRACKED_FIELDS]))


def diff(previous: DataFrame, current: DataFrame, detected_at: str, *, initial: bool = False) -> DataFrame:
    """C1-C6, X6-X8. Rows of CHANGE_SCHEMA of two snapshots. initial: no rows at all."""
    if initial:
        return current.sparkSession.createDataFrame([], CHANGE_SCHEMA)
    side = lambda df, n: df.select(*STORE_COLUMNS, "stable_key", F.lit(n).alias("side"))
    return diff_sides(side(previous, "p").unionByName(side(current, "c")), detected_at)


def diff_sides(rows: DataFrame, detected_at: str) -> DataFrame:
    """As diff, of one table of rows with side p (previous) or c (current)."""
    return describe(best_sides(rows), detected_at)


def best_sides(rows: DataFrame) -> DataFrame:
    """(stable_key, p, c) of rows with side p or c: one grouping by stable_key picks the best row of each side and
    brings them together, so there is one shuffle, combined before it, and no join."""
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*preference(), F.col("collected_at")])])
    best = lambda n: F.max_by(F.when(F.col("side") == n, F.col("row")), F.when(F.col("side") == n, F.col("order"))).alias(n)
    return rows.select("stable_key", "side", sided().alias("row"), order.alias("order")).groupBy("stable_key").agg(best("p"), best("c"))


def sided() -> Column:
    """A row as one side of a comparison: its fields and the alias by which urls are compared."""
    return F.struct(*STORE_COLUMNS, compare_url(F.col("source_url")).alias("alias"))


def describe(both: DataFrame, detected_at: str) -> DataFrame:
    """Rows of CHANGE_SCHEMA from (stable_key, p, c), a key's rows as sided() has them, null where a side has none."""
    both = both.withColumn("f", F.when(F.col("p").isNotNull() & F.col("c").isNotNull(), changed_fields()))
    both = both.where("f is null or size(f) > 0")
    kind = F.when(F.col("p").isNull(), "added").when(F.col("c").isNull(), "removed").otherwise("changed")
    shown = lambda n: F.when(F.col("c").isNull(), F.col(f"p.{n}")).otherwise(F.col(f"c.{n}"))
    whole = lambda s: payload({n: F.col(f"{s}.{n}") for n in STORE_COLUMNS})
    part = lambda s: payload({n: F.when(F.array_contains("f", n), F.col(f"{s}.{n}")) for n in TRACKED_FIELDS})
    old = F.when(F.col("c").isNull(), whole("p")).when(F.col("f").isNotNull(), part("p"))
    new = F.when(F.col("p").isNull(), whole("c")).when(F.col("f").isNotNull(), part("c"))
    return both.select(*[shown(n).alias(n) for n in ("network", "region", "city", "address", "source_url")], kind.alias("change_type"), F.nullif(F.array_join("f", ","), F.lit("")).alias("changed_fields"), old.alias("old_value"), new.alias("new_value"), F.lit(detected_at).alias("detected_at"), "stable_key")


def change_order() -> list[Column]:
    """C7."""
    rank = F.coalesce(*[F.when(F.col("change_type") == k, v) for k, v in RANKS.items()], F.lit(99))
    return [rank, *[F.coalesce(F.col(c), F.lit("")) for c in ("network", "city", "address", "stable_key")]]


def change_counts(changes: DataFrame) -> DataFrame:
    """G2."""
    return changes.groupBy("change_type").agg(F.count("*").alias("n"))
