"""An extension: store rows as a stream, compared batch by batch with the current baseline."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.diff import diff
from ..sources import snapshot as S


def watch(stores: DataFrame, baseline: str, changes: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch is a full snapshot: its changes are written under the stream's id and batch number, then it is the next version.

    A version keeps the stream's id and batch in its commit, apart from its own number, so batch runs and other streams can share the baseline, and a new
    checkpoint goes on where the log stands. A batch that runs again after it was committed is compared with the version before its
    own, so it writes the same changes and no second version. An empty batch is a snapshot without stores.
    """

    def one(batch: DataFrame, n: int) -> None:
        writer = json.loads(S._read(batch.sparkSession, f"{checkpoint}/metadata"))["id"]
        apply_batch(batch, n, baseline, changes, writer=writer)

    return stores.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def apply_batch(batch: DataFrame, n: int, baseline: str, changes: str, *, writer: str = "stream") -> S.Version:
    spark, now = batch.sparkSession, f"batch-{n:020d}"
    current = S.snapshot_rows(batch).persist()
    S.adopt(spark, baseline, now)
    try:
        while True:
            done = S.committed_by(spark, baseline, writer, n)
            before = S.load(spark, baseline, before=done.number if done else None)
            found = diff(before.rows, current, now, initial=before.status != "loaded")
            found.write.mode("overwrite").parquet(f"{changes}/{writer}/{now}")
            if done:
                return done
            try:
                return S.save(current, baseline, now, ready=True, writer=writer, batch=n, after=before.version.number if before.version else -1)
            except S.Conflict:  # another writer was first: compare with its version
                continue
    finally:
        current.unpersist()
