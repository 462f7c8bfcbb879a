"""Report tables: data, statistics, orders, widths, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import ORDER_FIELDS, STORE_COLUMNS
from ..shared import cut
from .dedup import as_text

#: The names of the workbook's sheets.
SHEETS = ("Актуальные данные", "Изменения", "Статистика")


def snapshot_order() -> list[Column]:
    """O2. All fields as text, nulls empty."""
    return [as_text(c) for c in [*ORDER_FIELDS, "stable_key"]]


def data_order() -> list[Column]:
    """O1. Five fields with nulls last, then the snapshot's order."""
    first = ("network", "region", "city", "address", "source_url")
    return [x for c in first for x in (F.col(c).isNull(), F.col(c))] + snapshot_order()


def business_order() -> list[Column]:
    """O3. All canonical fields but the time as text, nulls and zeros empty."""
    return [as_text(c) for c in STORE_COLUMNS if c != "collected_at"]


def ranked(df: DataFrame, order: list[Column], to: str = "place") -> DataFrame:
    """df plus each row's place (long, from 1) by ascending values of the order, nulls first, without a task that holds the whole table.

    The rows are cut once, so their plan runs once whatever follows. Spark's range partitioner deals them out by the order, each
    partition numbers its sorted rows, and the partitions' counts, one row each, give the offsets. Rows that are equal in
    the whole order stand in any order among themselves. An empty table gives no rows.
    """
    keys = [f"__k{i}" for i in range(len(order))]
    once = cut(df.select("*", *[c.alias(k) for c, k in zip(order, keys, strict=True)]))
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's index in its partition
    dealt = once.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut(dealt.select(*df.columns, F.spark_partition_id().alias("__r"), inside.alias("__i")))
    counts = placed.groupBy("__r").agg(F.count("*").alias("__n"))
    before = counts.select("__r", (F.sum("__n").over(W.orderBy("__r")) - F.col("__n")).alias("__before"))  # one row a partition
    return placed.join(F.broadcast(before), "__r").withColumn(to, F.col("__before") + F.col("__i") + 1).drop("__r", "__i", "__before")


def network_stats(stores: DataFrame) -> DataFrame:
    """G1. Stores a network, a null network of its own."""
    return stores.groupBy("network").agg(F.count("*").alias("stores_count"))


def stats_order() -> list[Column]:
    """Most stores first, then by network, null last."""
    return [-F.col("stores_count"), F.col("network").isNull(), F.col("network")]


def column_widths(df: DataFrame, columns: list[str] = STORE_COLUMNS) -> DataFrame:
    """W3. (column, width): the longest value or header plus 2, within 12 and 80."""
    most = df.agg(*[F.max(F.char_length(F.col(c).cast("string"))).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.least(F.greatest(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(len(c))) + 2, F.lit(12)), F.lit(80)).alias("width")) for c in columns])
    return most.select(F.inline(pairs))


def samples(links: DataFrame, examples: int = 10) -> DataFrame:
    """G5. (reason, n, samples): links counted by why they were refused (null: accepted), with the first few hrefs of each.

    The counts combine before their shuffle. Of the links only each partition's first few a reason are sent: a reason that nearly all
    links share costs no task more than partitions times examples rows.
    """
    placed = links.select("reason", F.struct("rank", "on", "pos", "href").alias("__s"))
    first = placed.withColumn("__n", F.row_number().over(W.partitionBy("reason").orderBy("__s"))).where(F.col("__n") <= examples)
    picked = first.groupBy("reason").agg(F.transform(F.array_sort(F.collect_list("__s")), lambda x: x["href"]).alias("samples"))
    counts = links.groupBy("reason").agg(F.count("*").alias("n"))
    return counts.join(picked, counts.reason.eqNullSafe(picked.reason)).select(counts.reason, "n", "samples")


def first_strategy(rows: DataFrame, rank: str, group: list[str]) -> DataFrame:
    """O6. The rows of the least rank that has any, by group."""
    best = rows.groupBy(*group).agg(F.min(rank).alias("__best"))
    return rows.join(best, group).where(F.col(rank) == F.col("__best")).drop("__best")


def cap(rows: DataFrame, group: list[Column], order: list[Column], most: int) -> DataFrame:
    """O5. The first rows of each group; a limit that is the feature itself (pages of a city, samples)."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("__n") <= most).drop("__n")
