"""Helpers that the operators share: table reading, Arrow passes, tables in the shared folder, components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def give_back() -> None:
    """Return freed memory of this Python worker to the system: workers live on between tasks of different stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """mapInArrow with a function from one batch to a dict of output columns (None: no rows).

    Batches are bounded by Spark's Arrow limits on rows and bytes, so a worker holds one batch at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if not isinstance(out[f.name], pa.Array) else out[f.name].cast(f.type) for f in arrow_schema], schema=arrow_schema)
        give_back()

    return df.mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; one of our own only in local mode (tests), where driver and executors are one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="vitrine-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write a Parquet table in the shared folder and read it back.

    A lost executor loses none of it, unlike a local checkpoint. The folder's retention removes the tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/vitrine-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # what the written plan shuffled is of no more use; Spark drops such files once the driver has collected its garbage
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._vitrine_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialize() wrote, once nothing that is still to run reads them."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._vitrine_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Bits of possible()'s table: so many a key, and at most so many (8 MB).
KEY_BITS, MAX_BITS = 16, 1 << 26


def possible(df: DataFrame, key: str, few: DataFrame) -> DataFrame:
    """df with a column __maybe: true for all rows whose key is in few, and for a few others; false is certain.

    So an exact join need not move the rest. Keys of few (a table, cheap to read) set a bit each, by hash, in rows of 64 longs that are broadcast. With more
    than MAX_BITS / KEY_BITS keys more other rows are true, and the table stays as large as it is.
    """
    bits = max(4096, min(MAX_BITS, few.count() * KEY_BITS))
    place = F.pmod(F.xxhash64(F.col(key), F.lit(5)), F.lit(bits).cast("long"))
    row, word, bit = F.shiftright("__h", 12), F.shiftright("__h", 6).bitwiseAND(F.lit(63)).cast("int"), F.col("__h").bitwiseAND(F.lit(63)).cast("int")
    words = few.select(place.alias("__h")).groupBy(row.alias("__at"), word.alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(__h & 63 as int))")).alias("b"))
    rows = words.groupBy("__at").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"))
    rows = rows.select("__at", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("__words"))
    held = df.withColumn("__h", place).withColumn("__at", row).join(F.broadcast(rows), "__at", "left")
    return held.withColumn("__maybe", F.coalesce(F.bit_get(F.get("__words", word), bit) == 1, F.lit(False))).select(*[F.col(f"`{c}`") for c in df.columns], "__maybe")


def likely(df: DataFrame, key: str, few: DataFrame) -> DataFrame:
    """The rows of df whose key may be in few, as possible() finds them."""
    return possible(df, key, few).where("__maybe").drop("__maybe")


#: Keys that hold more than one in so many rows are split in a join: at most so many keys, and twice as many parts.
HOT_SHARE = 10_000


def join_split(left: DataFrame, right: DataFrame, key: str | list[str], how: str, *, counts: DataFrame, spread: str) -> DataFrame:
    """left joined with right on key (one row a key in right), rows of hot keys spread over many tasks.

    counts: (key, n) of left's rows; spread: a column of left whose hash deals a hot key's rows out. A key of more than
    1 / HOT_SHARE of the rows gets one part for each such share and right's row once for each part. Shares sum to 1, so hot keys are at most
    HOT_SHARE and their parts at most twice that, whatever the input: their list is broadcast. Null keys match nothing.
    """
    keys = [key] if isinstance(key, str) else key
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)  # one number
    share = F.col("n") * HOT_SHARE
    hot = materialize(counts.where(share > total).dropna(subset=keys).select(*keys, F.ceil(share / total).cast("int").alias("__parts")), "hot")
    a = left.join(F.broadcast(hot), keys, "left").withColumn("__part", F.when(F.col("__parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread, F.lit(77)), F.col("__parts")).cast("int"))).drop("__parts")
    b = right.join(F.broadcast(hot), keys, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return a.join(b, [*keys, "__part"], how).drop("__part")


def components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b of any one ordered type): rows (node, root), root one node of the component.

    Randomised contraction: each round every node hooks to the neighbour (or itself) with the least
    hash of (node, round), then to what that one hooks to; edges are relabelled, self loops and repeats go. Each
    round shrinks the remaining graph by a constant factor whatever its shape, so rounds grow with the
    logarithm of its size. Edges and hooks stay distributed and are cut with tables in the shared folder. Hubs are
    harmless: minima are combined before the shuffle, and joins have one row per node on one side.
    """
    spark = edges.sparkSession
    edges = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    used = [edges]
    for i in range(max_rounds):
        if edges.isEmpty():
            labels = materialize(labels, "labels")
            discard(*used)
            return labels
        order = lambda c: F.struct(F.xxhash64(c, F.lit(i)).alias("h"), c.alias("id"))  # noqa: B023, E731
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min(order(F.col("b"))).alias("m"))
        once = least.select("node", F.least(F.col("m"), order(F.col("node"))).getField("id").alias("to"))
        twice = once.join(once.select(F.col("node").alias("to"), F.col("to").alias("next")), "to").select("node", F.col("next").alias("to"))
        hooks = materialize(twice, "hooks")
        ha, hb = hooks.select(F.col("node").alias("a"), F.col("to").alias("ta")), hooks.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = edges.join(ha, "a").join(hb, "b").where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        edges = materialize(moved, "edges")
        used += [hooks, edges]
        labels = labels.join(hooks.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds on {spark.sparkContext.applicationId}")
