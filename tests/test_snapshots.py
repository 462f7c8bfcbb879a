"""The snapshot log: numbers, writers, documents, streams, and differences of stored versions."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from vitrine.operators.diff import diff
from vitrine.plans import runner
from vitrine.sources import snapshot as S
from vitrine.streaming.snapshots import apply_batch, watch

ROW = "network string, source_url string, work_time string"


def stores(spark, *hours):
    return spark.createDataFrame([("N", f"https://x.ru/shop/{i}", h) for i, h in enumerate(hours)], ROW)


def hours(loaded):
    return sorted(r.work_time for r in loaded.rows.collect())


def test_numbers_and_retention(spark, tmp_path):
    """Data without a commit is never read, older data goes, commits stay, a number is given once."""
    path = str(tmp_path / "it's")
    assert S.load(spark, path).status == "missing"
    made = [S.save(stores(spark, str(i)), path, "t") for i in range(5)]
    assert [v.number for v in made] == S.numbers(spark, path) == [0, 1, 2, 3, 4]
    kept = {p.name for p in (tmp_path / "it's").iterdir() if p.name.startswith("data-")}
    assert kept == {v.stored.folder.rsplit("/", 1)[-1] for v in made[-3:]}
    lost = S.write(S.snapshot_rows(stores(spark, "lost")), path, "t")
    assert hours(S.load(spark, path)) == ["4"] and hours(S.load(spark, path, before=4)) == ["3"]
    assert S.vacuum(spark, path) == [] and S.vacuum(spark, path, hours=-1) == [lost.folder.rsplit("/", 1)[-1]]
    assert hours(S.load(spark, path)) == ["4"]
    with pytest.raises(S.Conflict):
        S.save(stores(spark, "late"), path, "t", after=3)
    assert hours(S.load(spark, path)) == ["4"]


def test_two_writers_at_once(spark, tmp_path):
    path, gate, made = str(tmp_path / "s"), threading.Barrier(4), []

    def one(i):
        stored = S.write(S.snapshot_rows(stores(spark, str(i))), path, "t")
        gate.wait()
        made.append(S.commit(spark, path, stored, "t", writer=str(i)))

    threads = [threading.Thread(target=one, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v.number for v in made) == [0, 1, 2, 3] == S.numbers(spark, path)
    assert {S.version(spark, path, n).writer for n in range(4)} == set("0123")
    assert hours(S.load(spark, path)) == [S.version(spark, path, 3).writer]


def test_put_if_absent_has_one_winner(spark, tmp_path):
    path, won = str(tmp_path / "c" / "1.json"), []
    threads = [threading.Thread(target=lambda i=i: S.put_if_absent(spark, path, str(i) * 10_000) and won.append(i)) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and S._read(spark, path) == str(won[0]) * 10_000
    assert [p.name for p in (tmp_path / "c").iterdir()] == ["1.json"]


def test_rename_does_not_overwrite(spark, tmp_path):
    """The way of file systems other than the local one."""
    for text, want in (("a", True), ("b", False)):
        S._write(spark, str(tmp_path / f".{text}"), text)
        assert S._rename_new(spark, str(tmp_path / f".{text}"), str(tmp_path / "one")) is want
    assert S._read(spark, str(tmp_path / "one")) == "a" and not (tmp_path / ".b").exists()


def document(path, *hours):
    path.write_text(json.dumps({"schema_version": 1, "stores": [{"network": "N", "source_url": f"https://x.ru/shop/{i}", "work_time": h} for i, h in enumerate(hours)]}))


@pytest.mark.parametrize("named", ["r_snapshot.json", None])
def test_document_baseline_is_followed_by_version_1(spark, tmp_path, named):
    """Given by name or found beside the output; it stays as it was, and the next runs go on from the log."""
    doc, out = tmp_path / "r_snapshot.json", str(tmp_path / "r.xlsx")
    document(doc, "8-20", "9-21")
    text = doc.read_text()
    snapshot = str(tmp_path / named) if named else None
    first = runner.run(spark, {"a": lambda s: stores(s, "8-22", "9-21")}, out, snapshot)
    assert (first.exit_code, first.initial) == (0, False)
    assert [(r.change_type, r.changed_fields) for r in first.changes.collect()] == [("changed", "work_time")]
    folder = str(tmp_path / "r_snapshot")
    assert S.numbers(spark, folder) == [0, 1] and S.version(spark, folder, 0).writer == "document" and doc.read_text() == text
    second = runner.run(spark, {"a": lambda s: stores(s, "8-22")}, out, snapshot)
    assert [(r.change_type, r.changed_fields) for r in second.changes.collect()] == [("removed", None)]
    assert S.numbers(spark, folder) == [0, 1, 2]


def test_invalid_document_is_made_anew(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"stores": {}}')
    got = runner.run(spark, {"a": lambda s: stores(s, "8-22")}, str(tmp_path / "r.xlsx"), str(tmp_path / "b.json"))
    assert (got.exit_code, got.status, got.initial) == (0, "invalid", True)
    assert hours(S.load(spark, str(tmp_path / "b.json"))) == ["8-22"]


def test_failed_source_keeps_the_baseline(spark, tmp_path):
    def bad(s):
        raise ValueError("no")

    path, out = str(tmp_path / "s"), str(tmp_path / "r.xlsx")
    S.save(stores(spark, "8-20"), path, "t")
    assert runner.run(spark, {"a": lambda s: stores(s, "8-22"), "b": bad}, out, path).exit_code == 1
    assert S.numbers(spark, path) == [0] and len([p for p in (tmp_path / "s").iterdir() if p.name.startswith("data-")]) == 1


def changes(spark, out, writer, n):
    return sorted((r.change_type, r.changed_fields) for r in spark.read.parquet(f"{out}/{writer}/batch-{n:020d}").collect())


def test_batch_again(spark, tmp_path):
    """A batch that is run again, before or after its version was committed, gives the same changes and no second version."""
    base, out = str(tmp_path / "b"), str(tmp_path / "c")
    apply_batch(stores(spark, "8-20", "9-21"), 0, base, out)
    apply_batch(stores(spark, "8-22", "9-21", "1-2"), 1, base, out)
    want = [("added", None), ("changed", "work_time")]
    assert changes(spark, out, "stream", 0) == [] and changes(spark, out, "stream", 1) == want
    apply_batch(stores(spark, "8-22", "9-21", "1-2"), 1, base, out)
    assert changes(spark, out, "stream", 1) == want and S.numbers(spark, base) == [0, 1]


def test_batch_compares_with_a_version_that_came_between(spark, tmp_path, monkeypatch):
    base, out = str(tmp_path / "b"), str(tmp_path / "c")
    S.save(stores(spark, "8-20"), base, "t")
    plain, once = S.save, []

    def slow(*a, **k):
        if k.get("writer") == "stream" and not once:
            once.append(plain(stores(spark, "8-21"), base, "t", writer="run"))
        return plain(*a, **k)

    monkeypatch.setattr(S, "save", slow)
    v = apply_batch(stores(spark, "8-21", "1-2"), 0, base, out)
    assert v.number == 2 and changes(spark, out, "stream", 0) == [("added", None)]


def test_stream_new_checkpoint_and_runs_share_a_baseline(spark, tmp_path):
    src, base, out = (str(tmp_path / x) for x in ("in", "b", "c"))
    S.save(stores(spark, "0-1"), base, "t", writer="run")
    go = lambda k: watch(spark.readStream.schema(ROW).parquet(src), base, out, str(tmp_path / k)).awaitTermination(120)
    name = lambda k: json.loads((tmp_path / k / "metadata").read_text())["id"]
    stores(spark, "8-20").coalesce(1).write.parquet(src)
    go("k1")
    assert changes(spark, out, name("k1"), 0) == [("changed", "work_time")]
    S.save(stores(spark, "8-21"), base, "t", writer="run")
    stores(spark, "8-21", "1-2").coalesce(1).write.mode("append").parquet(src)
    go("k1")  # its batch 1 holds the new file only and follows the run's version
    assert changes(spark, out, name("k1"), 1) == [("added", None)]
    go("k2")  # a new checkpoint starts at batch 0 with both files, and goes on where the log stands
    assert S.numbers(spark, base) == [0, 1, 2, 3, 4]
    assert [(S.version(spark, base, n).writer, S.version(spark, base, n).batch) for n in (1, 3, 4)] == [(name("k1"), 0), (name("k1"), 1), (name("k2"), 0)]


def many(spark, n, changed=()):
    i = F.col("id")
    rows = spark.range(n).select(F.lit("N").alias("network"), F.lit("R").alias("region"), F.lit("C").alias("city"), F.concat(F.lit("ул. Новая, "), i).alias("address"), F.when(i.isin(*changed), "1-2").otherwise("8-20").alias("work_time"), F.concat(F.lit("https://x.ru/shop/"), i).alias("source_url"), F.lit(f"t{n}").alias("collected_at"))
    return S.snapshot_rows(rows)


def test_diff_of_stored_versions_skips_what_is_equal(spark, tmp_path):
    """No exchange on either side, slices whose digests are equal aren't read, the rows are those of the plain diff."""
    path = str(tmp_path / "s")
    a = S.write(many(spark, 500), path, "t", slices=16, buckets=3)
    b = S.write(many(spark, 501, (7,)), path, "u", like=a)
    got = S.diff_stored(spark, a, b, "now")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan or "ShuffledHashJoin" in plan and "Exchange" not in plan
    files = {f.split("slice=")[1].split("/")[0] for f in got.inputFiles()}
    assert 1 <= len(files) <= 2
    want = diff(many(spark, 500), many(spark, 501, (7,)), "now")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and len(got.collect()) == 2
    same = S.write(many(spark, 500).withColumn("collected_at", F.lit("later")), path, "v", like=a)
    assert S.diff_stored(spark, a, same, "now").count() == 0 and same.digest == a.digest


def test_diff_of_unlike_layouts_and_empty_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    a, b = S.write(many(spark, 40), path, "t", slices=4, buckets=2), S.write(many(spark, 41), path, "t", slices=8, buckets=3)
    none = S.write(many(spark, 0), path, "t", like=a)
    assert [r.change_type for r in S.diff_stored(spark, a, b, "now").collect()] == ["added"]
    assert S.diff_stored(spark, none, a, "now").where("change_type = 'added'").count() == 40
    assert S.diff_stored(spark, a, none, "now").where("change_type = 'removed'").count() == 40
    assert S.diff_stored(spark, none, none, "now").count() == 0


def test_digest_sees_nulls_in_another_column(spark):
    one = many(spark, 1)
    move = one.withColumns({"phone": F.col("status"), "status": F.col("phone")})
    x, y = one.withColumn("phone", F.lit("1")), one.withColumn("status", F.lit("1"))
    assert S.digests(one, 1).collect() == S.digests(move, 1).collect()
    assert S.digests(x, 1).collect() != S.digests(y, 1).collect()
