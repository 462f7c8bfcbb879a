"""Snapshot store: a log of numbered commits over folders of data that are written once.

A version's rows lie in a folder of their own, and its commit is a small file `_commits/<number>.json` that is put only where none is: of
two writers at once one takes the number and the other the next, so every number has one writer, no version is lost, and a writer that dies leaves a folder that
nobody reads. Commits stay, with who wrote them; the data of all but the last KEEP versions goes. A JSON document beside the folder, as older programs
keep one, counts as version 0 until there is a log, and is imported as such by the first save.

Rows are dealt into slices by a hash of stable_key and, within them, bucketed by it. A commit keeps a digest of every slice: two
versions are compared from their digests down, slices that are equal aren't read, and what is read meets bucket by bucket without a shuffle.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import asdict, dataclass
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import canonical, compare_url, stable_key
from ..operators.dedup import keep_best
from ..operators.diff import describe, sided
from ..schemas import CHANGE_SCHEMA, SNAPSHOT_SCHEMA, STORE_COLUMNS, TRACKED_FIELDS

SCHEMA_VERSION, KEEP = 1, 3
SLICES, SMALL, BUCKET_ROWS, MAX_BUCKETS = 32, 10_000, 100_000, 512
STORED = f"{SNAPSHOT_SCHEMA}, schema_version int, saved_at string"


class Conflict(Exception):
    """Another writer has committed since the version that this one is based on."""


@dataclass(frozen=True)
class Stored:
    """Rows in a folder, committed or not: their layout, and the digests of their slices as JSON."""

    folder: str
    slices: int
    buckets: int
    digest: str


@dataclass(frozen=True)
class Version:
    """A commit. writer and batch name who made it, so that a stream's batch that runs again finds its own."""

    number: int
    saved_at: str
    writer: str
    batch: int | None
    stored: Stored


@dataclass
class Loaded:
    """rows of SNAPSHOT_SCHEMA; status: missing, invalid or loaded; version: of what was loaded, None for a document."""

    rows: DataFrame
    status: str
    version: Version | None = None


def snapshot_rows(stores: DataFrame, *, passes: int = 3) -> DataFrame:
    """Canonical rows with recomputed keys, one for each key."""
    return keep_best(stable_key(canonical(stores, passes=passes)))


# --- files ----------------------------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether a file of this name could be made; it is there as a whole or not at all.

    A local file is linked from a temporary one, elsewhere one is renamed without overwriting: both are atomic (on HDFS and on file systems like it).
    """
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    temporary = f"{p.getParent()}/.{p.getName()}.{uuid.uuid4().hex}"
    if fs.getScheme() == "file":
        local, target = urlparse(temporary).path, p.toUri().getPath()
        with open(local, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(local, target)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
    _write(spark, temporary, text)
    return _rename_new(spark, temporary, path)


def _rename_new(spark: SparkSession, source: str, target: str) -> bool:
    jvm, (fs, p) = spark._jvm, _fs(spark, target)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf()).rename(jvm.org.apache.hadoop.fs.Path(source), p, options)
        return True
    except Exception as e:
        _fs(spark, source)[0].delete(jvm.org.apache.hadoop.fs.Path(source), False)
        if "FileAlreadyExistsException" in str(e):
            return False
        raise


# --- the log --------------------------------------------------------------------------------------------------------


def home(path: str) -> tuple[str, str]:
    """Folder of the log and document beside it, of either's name."""
    folder = path.removesuffix(".json")
    return folder, f"{folder}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits, in order."""
    fs, p = _fs(spark, f"{home(path)[0]}/_commits")
    if not fs.exists(p):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def version(spark: SparkSession, path: str, number: int) -> Version:
    d = json.loads(_read(spark, f"{home(path)[0]}/_commits/{number:020d}.json"))
    return Version(d["number"], d["saved_at"], d["writer"], d["batch"], Stored(**d["stored"]))


def committed_by(spark: SparkSession, path: str, writer: str, batch: int) -> Version | None:
    """The version of a stream's batch; a stream's batches are in order, so the search ends at an earlier one of its own."""
    for n in reversed(numbers(spark, path)):
        v = version(spark, path, n)
        if v.writer == writer and v.batch is not None and v.batch <= batch:
            return v if v.batch == batch else None
    return None


def commit(spark: SparkSession, path: str, stored: Stored, saved_at: str, *, writer: str = "", batch: int | None = None, after: int | None = None) -> Version:
    """Give stored rows the next number. after: the version they are based on (-1: none); if another came since, Conflict."""
    folder = home(path)[0]
    number = max(numbers(spark, path), default=-1) + 1 if after is None else after + 1
    while True:
        v = Version(number, saved_at, writer, batch, stored)
        if put_if_absent(spark, f"{folder}/_commits/{number:020d}.json", json.dumps(asdict(v) | {"schema_version": SCHEMA_VERSION}, ensure_ascii=False)):
            break
        if after is not None:
            raise Conflict(f"version {number} of {folder} is taken")
        number += 1
    for old in [n for n in numbers(spark, path) if n <= number][:-KEEP]:
        remove(spark, version(spark, path, old).stored)
    return v


def remove(spark: SparkSession, stored: Stored) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_name(stored)}")
    fs, p = _fs(spark, stored.folder)
    fs.delete(p, True)


def vacuum(spark: SparkSession, path: str, *, hours: float = 24) -> list[str]:
    """Remove data that no commit names and that is older than the hours, left by writers that died. Returns the folders."""
    folder = home(path)[0]
    fs, p = _fs(spark, folder)
    known = {version(spark, path, n).stored.folder.rsplit("/", 1)[-1] for n in numbers(spark, path)[-KEEP:]}
    found = [x for x in fs.listStatus(p) if x.isDirectory() and x.getPath().getName().startswith("data-")] if fs.exists(p) else []
    stale = [x.getPath() for x in found if x.getPath().getName() not in known and x.getModificationTime() < (time.time() - hours * 3600) * 1000]
    for q in stale:
        fs.delete(q, True)
    return [q.getName() for q in stale]


# --- rows -----------------------------------------------------------------------------------------------------------


def _slice(slices: int) -> Column:
    return F.pmod(F.xxhash64("stable_key", F.lit(11)), F.lit(slices)).cast("int")


def digests(rows: DataFrame, slices: int) -> DataFrame:
    """(slice, n, a, b): rows and two 64-bit sums over all that a comparison of versions looks at. At most `slices` rows."""
    seen = ["stable_key", *[c for c in TRACKED_FIELDS if c != "source_url"]]
    alias = compare_url(F.col("source_url"))
    marks = F.concat_ws("", *[F.when(F.col(c).isNull(), "0").otherwise("1") for c in seen], F.when(alias.isNull(), "0").otherwise("1"))  # a hash passes over nulls
    h = lambda seed: F.xxhash64(F.lit(seed), marks, *seen, alias)
    return rows.groupBy(_slice(slices).alias("slice")).agg(F.count("*").alias("n"), F.bit_xor(h(1)).alias("a"), F.bit_xor(h(2)).alias("b"))


def layout(rows: int) -> tuple[int, int]:
    """Slices and buckets for so many rows."""
    return (SLICES if rows > SMALL else 1), min(MAX_BUCKETS, max(1, -(-rows // BUCKET_ROWS)))


def write(rows: DataFrame, path: str, saved_at: str, *, like: Stored | None = None, slices: int | None = None, buckets: int | None = None) -> Stored:
    """Rows of SNAPSHOT_SCHEMA, one a key, in a folder of their own; not yet a version. like: take over its layout, so that the two compare."""
    spark, folder = rows.sparkSession, f"{home(path)[0]}/data-{uuid.uuid4().hex}"
    if like is None or slices:
        some = layout(rows.count())
        slices, buckets = slices or some[0], buckets or some[1]
    else:
        slices, buckets = like.slices, like.buckets
    out = rows.select(*[c.split()[0] for c in SNAPSHOT_SCHEMA.split(", ")], F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(saved_at).alias("saved_at"))
    name = f"vitrine_write_{uuid.uuid4().hex}"
    dealt = out.withColumn("slice", _slice(slices)).repartition(buckets, "stable_key")  # as the buckets are: a task writes one bucket
    dealt.write.partitionBy("slice").bucketBy(buckets, "stable_key").sortBy("stable_key").option("path", folder).format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # its data stays
    stored = Stored(folder, slices, buckets, "")
    parts = sorted(tuple(r) for r in digests(read(spark, stored), slices).collect())  # at most `slices`
    return Stored(folder, slices, buckets, json.dumps(parts))


def _name(stored: Stored) -> str:
    return f"vitrine_read_{stored.folder.rsplit('data-', 1)[-1]}"


def read(spark: SparkSession, stored: Stored) -> DataFrame:
    """The stored rows with their slice, as a table whose partitions and buckets Spark knows."""
    name = _name(stored)
    if not spark.catalog.tableExists(name):
        where = stored.folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({STORED}, slice int) USING parquet PARTITIONED BY (slice) CLUSTERED BY (stable_key) SORTED BY (stable_key) INTO {stored.buckets} BUCKETS LOCATION '{where}'")
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def save(stores: DataFrame, path: str, saved_at: str, *, ready: bool = False, writer: str = "", batch: int | None = None, after: int | None = None) -> Version:
    """W1. Write and commit a version; a document beside becomes version 0 first. ready: stores are snapshot rows already."""
    spark = stores.sparkSession
    adopt(spark, path, saved_at)
    last = max(numbers(spark, path), default=None)
    like = version(spark, path, last).stored if last is not None else None
    return commit(spark, path, write(stores if ready else snapshot_rows(stores), path, saved_at, like=like), saved_at, writer=writer, batch=batch, after=after)


def adopt(spark: SparkSession, path: str, saved_at: str) -> None:
    """Import the document beside an empty log as version 0; if another writer does so at the same time, one of the two counts."""
    if numbers(spark, path):
        return
    found = _document(spark, home(path)[1], passes=1)
    if found.status == "loaded":
        try:
            commit(spark, path, write(found.rows, path, saved_at), saved_at, writer="document", after=-1)
        except Conflict:
            pass


def load(spark: SparkSession, path: str, *, passes: int = 1, before: int | None = None) -> Loaded:
    """S17. The current version (before: the last with a smaller number), or the document beside; keys are recomputed, rows deduplicated."""
    known = [n for n in numbers(spark, path) if before is None or n < before]
    if known:
        v = version(spark, path, known[-1])
        return Loaded(snapshot_rows(read(spark, v.stored), passes=passes), "loaded", v)
    if numbers(spark, path):
        return Loaded(spark.createDataFrame([], SNAPSHOT_SCHEMA), "missing")
    return _document(spark, home(path)[1], passes=passes)


def _document(spark: SparkSession, path: str, *, passes: int) -> Loaded:
    empty = spark.createDataFrame([], SNAPSHOT_SCHEMA)
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return Loaded(empty, "missing")
    doc = spark.read.option("wholetext", True).text(path).select(F.try_parse_json("value").alias("v"))
    listed = F.try_variant_get("v", "$.stores", "array<variant>")
    ok = doc.select((F.schema_of_variant("v").startswith("OBJECT") & F.schema_of_variant(F.try_variant_get("v", "$.stores", "variant")).startswith("ARRAY")).alias("ok")).first()
    if not ok or not ok.ok:
        return Loaded(empty, "invalid")
    rows = doc.select(F.posexplode(listed).alias("pos", "s")).where(F.schema_of_variant("s").startswith("OBJECT"))
    return Loaded(snapshot_rows(json_rows(rows), passes=passes), "loaded")


def diff_stored(spark: SparkSession, previous: Stored, current: Stored, detected_at: str, *, only: Column | None = None) -> DataFrame:
    """C1-C6 of two stored snapshots, from the digests down: equal slices aren't read, the others meet without a shuffle.

    only: a condition on previous rows that all current ones meet (a diff of some networks). Of unlike layouts all slices are read.
    """
    differ = None
    if (previous.slices, previous.buckets) == (current.slices, current.buckets):
        a, b = ({x[0]: x[1:] for x in json.loads(v.digest)} for v in (previous, current))
        differ = sorted(k for k in a.keys() | b.keys() if a.get(k) != b.get(k))  # at most SLICES
        if not differ:
            return spark.createDataFrame([], CHANGE_SCHEMA)
    sides = []
    for stored, condition in ((previous, only), (current, None)):
        rows = read(spark, stored)
        rows = rows if differ is None else rows.where(F.col("slice").isin(differ))
        rows = rows if condition is None else rows.where(condition)
        sides.append(rows.select("stable_key", sided().alias("c" if sides else "p")))
    return describe(sides[0].join(sides[1], "stable_key", "full"), detected_at)


def json_rows(rows: DataFrame, s: str = "s") -> DataFrame:
    """Canonical columns of store objects as text; of older names the first that is present counts, null or not."""
    from ..schemas import ALIASES, STORE_COLUMNS

    def pick(name: str):
        out = F.lit(None).cast("string")
        for n in reversed((name, *ALIASES.get(name, ()))):
            here = F.try_variant_get(s, f"$.{n}", "variant")
            out = F.when(here.isNotNull(), F.try_variant_get(s, f"$.{n}", "string")).otherwise(out)
        return out

    return rows.select(*[pick(n).alias(n) for n in STORE_COLUMNS])
