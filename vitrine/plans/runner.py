"""One run: sources to canonical rows, differences against the baseline, report, new baseline; and its exit status."""

from __future__ import annotations

import argparse
import logging
import os
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.identity import canonical, stable_key
from ..operators.dedup import keep_best
from ..operators.diff import change_order, diff
from ..operators.report import data_order, network_stats, stats_order
from ..schemas import CHANGE_COLUMNS, STORE_COLUMNS, STORE_SCHEMA
from ..sources import snapshot as S
from ..sources.workbook import write_tables, write_workbook
from . import config as C

OK, FAILED, INTERRUPTED = 0, 1, 130
log = logging.getLogger("vitrine")


@dataclass
class Result:
    exit_code: int
    changes: DataFrame
    status: str
    initial: bool
    failed: list[str]
    counts: dict[str, int]


def setup_logging(cfg: C.Config) -> None:
    """W6. File and console; chatter of HTTP libraries below errors is muted."""
    os.makedirs(os.path.dirname(os.path.abspath(cfg.log_file)), exist_ok=True)
    logging.basicConfig(level=cfg.log_level, format="%(asctime)s | %(levelname)s | %(name)s | %(message)s", handlers=[logging.FileHandler(cfg.log_file, encoding="utf-8"), logging.StreamHandler()], force=True)
    logging.getLogger("urllib3").setLevel(logging.ERROR)


def default_snapshot(output: str) -> str:
    """W4. Beside the output: its stem and _snapshot."""
    head, name = os.path.split(output)
    return os.path.join(head, os.path.splitext(name)[0] + "_snapshot")


def set_aside(rejected: DataFrame, path: str, name: str) -> None:
    """E4, P8. What could not be read, as JSON lines (url, reason) of this run."""
    rejected = rejected.persist()
    reasons = {r.reason: r.n for r in rejected.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    if reasons:
        log.warning("source %s: set aside %s in %s", name, reasons, path)
        rejected.write.mode("overwrite").json(path)
    rejected.unpersist()


def collect_sources(spark: SparkSession, sources: dict[str, Callable[[SparkSession], DataFrame]], now: str, aside: str) -> tuple[list[DataFrame], list[str]]:
    """E1-E3. The sources' canonical rows, materialised side by side, in the sources' order; and the names of those that failed.

    A source has a thread, a scheduler pool (of equal share under FAIR) and a job tag of its own. An interrupt, of the program or of a source, cancels the
    jobs of all tags until every thread has ended, and is raised again.
    """
    run_id, sc = uuid.uuid4().hex, spark.sparkContext

    def one(i: int, name: str, source: Callable[[SparkSession], DataFrame]) -> DataFrame:
        sc.setLocalProperty("spark.scheduler.pool", name)
        sc.addJobTag(f"vitrine-{run_id}-{i}")
        try:
            found = source(spark)
            rows = canonical(found, passes=1, collected_at=now).withColumn("chain", F.lit(i)).persist()
            n = rows.count()
            log.log(logging.INFO if n else logging.WARNING, "source %s: %s rows", name, n)  # E7: none is a success all the same
            if n and (counts := getattr(found, "counts", dict)()):  # G3, G4
                log.log(logging.WARNING if counts.get("conflicts") else logging.INFO, "source %s: %s", name, counts)
            if getattr(found, "rejected", None) is not None:
                set_aside(found.rejected, f"{aside}/{name}", name)
            for cached in getattr(found, "held", ()):
                cached.unpersist()
            return rows
        finally:
            sc.removeJobTag(f"vitrine-{run_id}-{i}")
            sc.setLocalProperty("spark.scheduler.pool", None)

    parts, failed, stopped = [], [], False
    with ThreadPoolExecutor(max_workers=max(1, len(sources))) as pool:
        tasks = {name: pool.submit(inheritable_thread_target(spark)(one), i, name, source) for i, (name, source) in enumerate(sources.items())}
        try:
            while not (stopped or all(t.done() for t in tasks.values())):
                wait(tasks.values(), timeout=0.5)
                stopped = any(t.done() and isinstance(t.exception(), KeyboardInterrupt) for t in tasks.values())
        except KeyboardInterrupt:
            stopped = True
        while stopped and not all(t.done() for t in tasks.values()):  # a source may begin another job between two rounds
            for i in range(len(tasks)):
                sc.cancelJobsWithTag(f"vitrine-{run_id}-{i}")
            wait(tasks.values(), timeout=0.2)
    if stopped:
        for t in tasks.values():
            if t.exception() is None:
                t.result().unpersist()
        raise KeyboardInterrupt
    for name, t in tasks.items():
        if t.exception() is None:
            parts.append(t.result())
        else:
            log.error("source %s failed", name, exc_info=t.exception())
            failed.append(name)
    return parts, failed


def run(spark: SparkSession, sources: dict[str, Callable[[SparkSession], DataFrame]], output: str, snapshot: str | None = None, *, network: str | None = None, scoped: bool = False, now: str | None = None, tables: str | None = None) -> Result:
    """E1, E2, P11, U1. Each source is materialised on its own, side by side, so that one that fails leaves the others; then the
    differences count as initial, the baseline stays and the exit code is 1. An empty source is a success (E7).

    scoped: compare only with baseline rows of the networks that this run has; by default a run of one network
    reports all others as removed. tables: a folder in which the report's tables are written, too, in order.
    """
    began, now = time.time(), now or datetime.now(timezone.utc).isoformat()
    chosen = {network: sources[network]} if network else sources
    snapshot = snapshot or default_snapshot(output)
    aside = f"{default_snapshot(output).removesuffix('_snapshot')}_rejected"
    try:
        parts, failed = collect_sources(spark, chosen, now, aside)
    except KeyboardInterrupt:
        log.warning("interrupted after %.2f s", time.time() - began)
        return Result(INTERRUPTED, diff(*[spark.createDataFrame([], STORE_SCHEMA)] * 2, now, initial=True), "missing", True, [], {})
    stores = spark.createDataFrame([], STORE_SCHEMA).withColumn("chain", F.lit(0))
    for p in parts:
        stores = stores.unionByName(p)
    current = keep_best(stable_key(canonical(stores, passes=2, keep=("chain",))), F.col("chain")).select(*STORE_COLUMNS, "stable_key").persist()
    before = S.load(spark, snapshot)
    if before.status == "invalid":
        log.warning("the baseline %s can't be read and is made anew", snapshot)
    initial = bool(failed) or before.status != "loaded"
    stored = S.write(current, snapshot, now, like=before.version.stored if before.version else None)
    if before.version and not initial:
        changes = S.diff_stored(spark, before.version.stored, stored, now, only=_networks(current) if scoped else None).persist()
    else:
        base = before.rows
        if scoped:
            base = base.where(_networks(current))
        changes = diff(base, current, now, initial=initial).persist()
    counts = {r.change_type: r.n for r in changes.groupBy("change_type").agg(F.count("*").alias("n")).collect()} | {"stores": current.count()}
    stats = network_stats(current)
    report = [(current, STORE_COLUMNS, data_order()), (changes, CHANGE_COLUMNS, change_order()), (stats, stats.columns, stats_order())]
    write_workbook(output, report)
    if tables:
        write_tables(tables, report)
    if failed:
        log.warning("baseline kept, failed: %s", failed)
        S.remove(spark, stored)
    else:  # W5
        S.adopt(spark, snapshot, now)
        S.commit(spark, snapshot, stored, now, writer="run")
    for cached in (*parts, current):
        cached.unpersist()
    log.info("done in %.2f s: %s", time.time() - began, counts)
    return Result(FAILED if failed else OK, changes, before.status, initial, failed, counts)


def _networks(current: DataFrame) -> Column:
    """Whether a row's network is one of the run's: as many as it has sources, and their spellings."""
    found = [r.network for r in current.select("network").distinct().collect()]
    return F.col("network").isin([n for n in found if n is not None])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vitrine")
    r = p.add_subparsers(dest="command").add_parser("run")
    r.add_argument("--network", choices=[*C.NETWORKS])
    r.add_argument("--output")
    r.add_argument("--snapshot")
    r.add_argument("--tables", help="folder for the report as Parquet tables in order, beside the workbook")
    r.add_argument("--fetched", help="table of fetched responses (url, status, final_url, body)")
    return p


def main(argv: list[str] | None = None) -> int:
    """Collect, compare and report. Without --fetched, urls are fetched by the workers."""
    from .chains import all_sources

    C.load_env_file()
    args, cfg = parser().parse_args(argv), C.from_env()
    setup_logging(cfg)
    spark = SparkSession.builder.appName("vitrine").config("spark.scheduler.mode", "FAIR").getOrCreate()
    fetched = getattr(args, "fetched", None)
    responses = spark.read.parquet(fetched) if fetched else None
    return run(spark, all_sources(cfg, responses), getattr(args, "output", None) or cfg.output, getattr(args, "snapshot", None) or cfg.snapshot, network=getattr(args, "network", None), tables=getattr(args, "tables", None)).exit_code
