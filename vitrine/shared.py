"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only in local mode, where driver and executors are one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if not where and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="vitrine-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there: computed once, with no plan before them, safe from lost executors."""
    shared_folder(df.sparkSession)
    kept = df.persist()  # a checkpoint reads its rows twice
    out = kept.checkpoint()
    kept.unpersist()
    return out


def put(df: DataFrame, *by: str) -> str:
    """The path of a Parquet table in the shared folder with the rows, in folders by columns. Unlike cut() nothing is cached first, and readers leave out columns."""
    path = f"{shared_folder(df.sparkSession)}/vitrine-put-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Delete what put() wrote, once nothing that is still to run reads it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


#: Rows that a task gets where a step costs far more than its rows weigh, and those below which a further task isn't worth it.
MOST_ROWS, LEAST_ROWS = 50_000, 1_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt out by keys that few of them share, to as many tasks as there is work for; for input files (their rows are counted first).

    Files are split by bytes, so millions of short rows can be one task's. This many tasks fill the cluster, and none has much over MOST_ROWS.
    """
    rows = df.count()
    tasks = max(min(2 * df.sparkSession.sparkContext.defaultParallelism, rows // LEAST_ROWS), -(-rows // MOST_ROWS))
    return df.repartition(tasks, *keys) if tasks > 1 else df


class Watch:
    """Aggregates of the rows that pass a place of a plan, taken by the job that runs the plan: no job of their own.

    A task that runs again because what it sent was lost may count its rows twice; these are figures for people and logs.
    """

    def __init__(self) -> None:
        self._seen, self._found = Observation(), None

    def on(self, rows: DataFrame, **aggregates: Column) -> DataFrame:
        return rows.observe(self._seen, *[c.alias(name) for name, c in aggregates.items()])

    def get(self, seconds: float = 20) -> dict[str, int] | None:
        """The aggregates once a job has run, else None after some seconds: an adaptive plan may leave out a part that turns out to be empty."""
        if self._found is None:
            def wait() -> None:
                self._found = {k: v or 0 for k, v in self._seen.get.items()}

            t = threading.Thread(target=wait, daemon=True)
            t.start()
            t.join(seconds)
        return self._found
