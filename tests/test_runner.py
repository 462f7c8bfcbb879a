"""Sources side by side, failures and interrupts; what the command line takes."""

import os
import threading
import time

import pytest

from vitrine.plans import runner
from vitrine.sources import snapshot as S

ROW = "network string, source_url string, work_time string"


def stores(spark, name):
    return spark.createDataFrame([(name, f"https://x.ru/shop/{name}", "8-20")], ROW)


def slow(spark, path, seconds):
    """A row from a task that leaves a mark, then sleeps."""

    def run(batches):
        for b in batches:
            open(path, "w").close()
            time.sleep(seconds)
            yield b

    return stores(spark, "slow").mapInPandas(run, ROW)


def waited(path):
    end = time.time() + 60
    while not os.path.exists(path) and time.time() < end:
        time.sleep(0.05)
    return os.path.exists(path)


def test_slow_and_failing_sources_overlap(spark, tmp_path):
    """The failing source ends while the slow one's task runs; the order of the parts is that of the sources."""
    mark, seen = str(tmp_path / "m"), []

    def bad(s):
        seen.append(waited(mark))
        raise ValueError("no")

    got = runner.run(spark, {"slow": lambda s: slow(s, mark, 4), "bad": bad, "quick": lambda s: stores(s, "quick")}, str(tmp_path / "r.xlsx"))
    assert (got.exit_code, got.failed, got.counts, seen) == (1, ["bad"], {"stores": 2}, [True])
    parts, failed = runner.collect_sources(spark, {n: (lambda s, n=n: stores(s, n)) for n in "cab"}, "t", str(tmp_path))
    assert [p.first().network for p in parts] == ["c", "a", "b"] and failed == []


def test_interrupt_cancels_what_runs(spark, tmp_path):
    mark, out = str(tmp_path / "m"), str(tmp_path / "r.xlsx")

    def stop(s):
        waited(mark)
        raise KeyboardInterrupt

    began = time.time()
    got = runner.run(spark, {"slow": lambda s: slow(s, mark, 60), "stop": stop}, out)
    assert got.exit_code == 130 and time.time() - began < 45
    assert list(spark.sparkContext.statusTracker().getActiveJobsIds()) == []
    assert not os.path.exists(out) and S.load(spark, runner.default_snapshot(out)).status == "missing"
    assert not [t for t in threading.enumerate() if "ThreadPool" in t.name]


def test_counts_come_from_the_job_that_makes_the_rows(spark, tmp_path, caplog):
    """Rows before and after deduplication and conflicts, through caches and shuffles; a source without rows waits for none."""
    from pyspark.sql import functions as F

    from vitrine.functions.identity import canonical, stable_key
    from vitrine.operators.dedup import keep_best_map
    from vitrine.plans import chains
    from vitrine.shared import Watch, cut

    rows = [("N", f"https://x.ru/shop/{i % 3}", f"{i % 2}") for i in range(8)]

    def once(s, data):
        made, counts = chains._watched(s.createDataFrame(data, ROW).repartition(3), [F.col("source_url")], [F.col("work_time")])
        return chains._source(made, [], counts=counts)

    def best(s):
        twice = Watch()
        keyed = stable_key(canonical(s.createDataFrame([*rows, rows[0], ("M", "https://y.ru/shop/9", "1")], ROW)))
        kept = keep_best_map(keyed, watch=twice)
        return chains._source(kept.drop("stable_key"), [], counts=twice.get)

    began = time.time()
    with caplog.at_level("INFO", "vitrine"):
        parts, failed = runner.collect_sources(spark, {"once": lambda s: once(s, rows), "none": lambda s: once(s, []), "best": best}, "t", str(tmp_path))
    assert failed == [] and [p.count() for p in parts] == [3, 0, 4] and time.time() - began < 60
    said = {(r.levelname, r.getMessage()) for r in caplog.records}
    assert ("INFO", "source once: {'rows': 8, 'kept': 3}") in said
    assert ("WARNING", "source best: {'removed': 6, 'conflicts': 3}") in said
    assert ("WARNING", "source none: 0 rows") in said and not [m for _, m in said if m.startswith("source none: {")]
    seen = Watch()
    cut(seen.on(spark.range(5), n=F.count("*"), odd=F.count_if(F.col("id") % 2 == 1)))
    assert seen.get() == {"n": 5, "odd": 2} and Watch().get(seconds=0.2) is None


@pytest.mark.parametrize("bad", [["run", "--network", "other"], ["walk"]])
def test_command_line_refuses(bad, capsys):
    with pytest.raises(SystemExit) as e:
        runner.parser().parse_args(bad)
    assert e.value.code == 2


def test_command_line():
    got = runner.parser().parse_args(["run", "--network", "kb", "--output", "o.xlsx", "--snapshot", "s.json"])
    assert (got.network, got.output, got.snapshot, got.fetched) == ("kb", "o.xlsx", "s.json", None)
    assert runner.parser().parse_args([]).command is None


def test_log_goes_to_file_and_console(tmp_path):
    import dataclasses
    import logging

    from vitrine.plans import config

    root, before = logging.getLogger(), (logging.getLogger().handlers[:], logging.getLogger().level)
    try:
        runner.setup_logging(dataclasses.replace(config.from_env(), log_file=str(tmp_path / "a" / "x.log"), log_level="INFO"))
        logging.getLogger("vitrine").info("привет")
        assert "| INFO | vitrine | привет" in (tmp_path / "a" / "x.log").read_text(encoding="utf-8")
        assert logging.getLogger("urllib3").level == logging.ERROR
    finally:
        root.handlers, root.level = before
