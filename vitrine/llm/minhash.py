"""Operator 8, MinHash near-duplicates with sequential Bayesian verification.

1. Documents with one shingle set are one class (a 128-bit digest of the set); the classes are compared from here on.
2. Banded MinHash: BANDS bands of ROWS hashes. A pair at the threshold 0.8 meets in no band with
   probability (1 - 0.8^6)^45 = 1.2e-6.
3. Every bucket links its members to its least one: as many links as members, never pairs. All links are held against the
   signatures in batches; a link is pruned once the posterior probability of similarity >= 0.8 falls under EPSILON.
   The components of the links that stay are cores. Where a bucket still holds members of several cores, those outside its least
   member's core are compared, again by signature, with each other and with the rest of the bucket, so no pair
   that met and isn't pruned lies across two clusters, and chance meetings join nothing.
4. Clusters (components of all links so far) are cut into blocks of bounded size; every pair of blocks of a cluster is a task. In it,
   survivors of the batches that aren't yet in one component are verified exactly on their full sets. A task
   returns each class's root, never pairs.
5. The components of those roots are the result.

Scale: rows grow with documents and bands, not with the square of a group; buckets are counted with map-side combining, and
joins split hot bands, sets and components. Texts and bands that can't be in a join are
left out before it by a bit table of its keys (common.possible), so what is shuffled goes with what is alike, not with all texts. Ids of components and links are never collected. A cluster of G different
texts that are all alike costs (G / block)^2 / 2 tasks, the price of losing no link among them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, components, discard, give_back, join_split, likely, materialize, possible, table, text_or_empty

BANDS, ROWS, BATCH, EPSILON = 45, 6, 54, 1e-7
BLOCK_DOCS, BLOCK_SHINGLES = 4096, 3_000_000
HASHES = BANDS * ROWS
_rng = np.random.default_rng(8)
_A = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_P, _Q, _R = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)
KNOWN_WORDS = 100_000
_known: dict[bytes, int] = {}


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; fewer words: the whole sequence as one; no words: none.

    bytes.lower() changes A-Z alone, bytes.split() cuts at ASCII white space alone.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_known) > KNOWN_WORDS:
        _known.clear()
    known, h = _known, xxhash.xxh3_64_intdigest
    for w in set(words):
        if w not in known:
            known[w] = h(w)
    x = np.array([known[w] for w in words], np.uint64)
    width = min(n, len(x))
    out = np.full(len(x) - width + 1, width, np.uint64)
    for i in range(width):
        out = (out ^ x[i : len(x) - width + 1 + i]) * _P
        out = (out ^ (out >> _R)) * _Q
    out ^= out >> _R
    return np.unique(out)


def signature(hashed: np.ndarray) -> np.ndarray:
    """MinHash signature: for each of HASHES linear functions the least value over the set."""
    x = ((hashed >> np.uint64(32)) ^ hashed).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        part = x[i : i + 2048]
        for j in range(0, HASHES, 54):
            v = part[None, :] * _A[j : j + 54, None]
            v += _B[j : j + 54, None]
            np.minimum(out[j : j + 54], v.min(axis=1), out=out[j : j + 54])
    return out


def set_node(hashed: np.ndarray) -> bytes:
    """Name of a set: 128 bits, so that no two different sets of a corpus are likely to share it."""
    return xxhash.xxh3_128_digest(hashed.tobytes())


@lru_cache(None)
def _least_matches(threshold: float, epsilon: float, hashes: int, batch: int) -> tuple[int, ...]:
    """Matches that a pair needs after each batch, or P(similarity >= threshold | matches) < epsilon.

    Signatures are kept as bytes, so a hash matches with q = s + (1 - s) / 256. Prior: uniform similarity.
    """
    s = (np.arange(4000) + 0.5) / 4000
    q = s + (1 - s) / 256
    out = []
    for n in range(batch, hashes + 1, batch):
        m = np.arange(n + 1)
        ll = m[:, None] * np.log(q) + (n - m)[:, None] * np.log1p(-q)
        p = np.exp(ll - ll.max(axis=1, keepdims=True))
        tail = p[:, s >= threshold].sum(axis=1) / p.sum(axis=1)
        out.append(int(np.argmax(tail >= epsilon)))
    return tuple(out)


def survivors(one: np.ndarray, many: np.ndarray, threshold: float) -> np.ndarray:
    """Rows of `many` (byte signatures) that the posterior bound doesn't prune against `one`, batch by batch."""
    at, got = np.arange(len(many)), np.zeros(len(many), np.int64)
    for i, least in enumerate(_least_matches(threshold, EPSILON, HASHES, BATCH)):
        cut = slice(i * BATCH, (i + 1) * BATCH)
        got = got + (many[at, cut] == one[cut]).sum(axis=1)
        ok = got >= least
        at, got = at[ok], got[ok]
        if not len(at):
            break
    return at


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact: 100 * |a & b| >= percent * |a | b|, on sorted distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sketch(n: int):
    def run(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in ("n_shingles", "node", "sig", "bands")} | {c: batch[c] for c in ("row", "doc_id")}
        salt = np.arange(BANDS, dtype=np.uint64) * _P
        for t in batch["text"].to_pylist():
            s = shingles(t, n)
            out["n_shingles"].append(len(s))
            if not len(s):
                for k in ("node", "sig", "bands"):
                    out[k].append(None)
                continue
            sig = signature(s)
            keys = np.frombuffer(b"".join([xxhash.xxh3_64_digest(r) for r in np.split(sig, BANDS)]), "<u8") ^ salt
            out["node"].append(set_node(s))
            out["sig"].append(((sig * np.uint32(0x2C1B3C6D)) >> np.uint32(24)).astype(np.uint8).tobytes())
            out["bands"].append(keys.view(np.int64))
        return out

    return run


def _judge(threshold: float):
    def run(batch: pa.RecordBatch) -> dict:
        a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("sa", "sb"))
        at, got = np.arange(len(a)), np.zeros(len(a), np.int64)
        for i, least in enumerate(_least_matches(threshold, EPSILON, HASHES, BATCH)):
            cut = slice(i * BATCH, (i + 1) * BATCH)
            got = got + (a[at, cut] == b[at, cut]).sum(axis=1)
            at, got = at[got >= least], got[got >= least]
        good = np.zeros(len(a), bool)
        good[at] = True
        return {"a": batch["a"], "b": batch["b"], "n": batch["n"], "good": good}

    return run


def link_block(names: list[bytes], sizes: np.ndarray, sigs: np.ndarray, sets: list[np.ndarray] | None, side: np.ndarray, percent: int, known: np.ndarray | None = None) -> np.ndarray:
    """Root position of each class of a task. side: 0 or 1; where both occur only pairs across sides are compared.

    sets: survivors of the signatures are verified on them; None: survivors count. known: numbers of components that are known.
    """
    order = np.array(sorted(range(len(names)), key=lambda i: (sizes[i], names[i])), np.int64)
    sizes_o, sigs_o, side_o = sizes[order], sigs[order], side[order]
    across = bool(side.any() and not side.all())
    top = np.searchsorted(sizes_o, sizes_o * 100 // percent, side="right")
    if known is None:
        roots = np.arange(len(names))
    else:
        _, first, at = np.unique(known[order], return_index=True, return_inverse=True)
        roots = first[at]
    for i in range(len(names)):
        if top[i] <= i + 1:
            continue
        js = np.arange(i + 1, top[i])
        js = js[roots[js] != roots[i]]  # what is known to be one component needs no comparison
        if across:
            js = js[side_o[js] != side_o[i]]
        if not len(js):
            continue
        for j in js[survivors(sigs_o[i], sigs_o[js], percent / 100)].tolist():
            a, b = roots[i], roots[j]
            if a != b and (sets is None or similar(sets[order[i]], sets[order[j]], percent)):
                roots[roots == max(a, b)] = min(a, b)
    out = np.empty(len(names), np.int64)
    out[order] = order[roots]
    return out


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each input row; component_id is the least doc_id reachable.

    docs needs doc_id (long) and text; more columns are ignored. Null or blank texts have no shingles, link
    with nothing and are kept; equal sets link. Rows that repeat a doc_id are returned each by its own
    text. Rows with a null doc_id link by their text: they are kept where no row of their component has an id (one of
    them, with a null component_id) or they have no shingles. Empty input: no rows.
    """
    return _found(docs, words, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _found(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of near_duplicates with node (their set; null: no shingles) and root (one node of the component)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    sketch = materialize(arrow_map(numbered, _sketch(words), "row long, doc_id long, n_shingles long, node binary, sig binary, bands array<bigint>"), "sketch")
    nameless = F.min(F.when(F.col("doc_id").isNull(), F.col("row")))
    best = F.min_by(F.struct("sig", "bands", "n_shingles"), "row").alias("x")
    sets = sketch.where("node is not null").groupBy("node").agg(best, F.min("doc_id").alias("doc_id"), nameless.alias("head"), F.count("*").alias("n"))
    sets = materialize(sets.select("node", "doc_id", "head", "n", "x.sig", "x.bands", "x.n_shingles"), "sets")
    clusters = _clusters(sets, percent)
    linked = _verify(docs, sets, clusters, words, percent)
    # a component's name is its least id; without any id its least row stays
    named = linked.join(sets.select("node", "doc_id", "head"), "node")
    groups = named.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.min("head").alias("first"), F.count("*").alias("n"))
    named = join_split(named, groups.drop("n"), "root", "inner", counts=groups.select("root", "n"), spread="node").select("node", "root", "component_id", "first")
    alone = sets.join(linked, "node", "left_anti").select("node", F.col("node").alias("root"), F.col("doc_id").alias("component_id"), F.col("head").alias("first"))
    own = sketch.select("row", "doc_id", "n_shingles", "node")
    out = join_split(own, named.unionByName(alone), "node", "left", counts=sets.select("node", "n"), spread="row").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    stays = F.col("component_id").isNull() & (F.col("root").isNull() | (F.col("row") == F.col("first")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), stays, F.lit(False)).alias("kept"), "node", "root")


def _clusters(sets: DataFrame, percent: int) -> DataFrame:
    """(node, cluster): components of the links between sets that met in a band and that their signatures don't rule out."""
    sig = sets.select("node", "sig")
    banded = sets.select("node", F.explode("bands").alias("band"))
    buckets = materialize(banded.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1"), "buckets")
    met = join_split(likely(banded, "band", buckets), buckets, "band", "inner", counts=buckets.select("band", "n"), spread="node").where("node <> least")
    met = met.groupBy(F.col("least").alias("a"), F.col("node").alias("b")).agg(F.max("n").alias("n"))
    pairs = met.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
    judged = materialize(arrow_map(pairs.select("a", "b", "n", "sa", "sb"), _judge(percent / 100), "a binary, b binary, n long, good boolean"), "judged")
    good = judged.where("good").select("a", "b")
    cores = components(good).withColumnRenamed("root", "core")
    # a member whose link was pruned can still be alike to another of a bucket of three or more
    core = lambda c, to: cores.select(F.col("node").alias(c), F.col("core").alias(to))
    bad = judged.where("not good and n > 2").join(core("a", "ca"), "a", "left").join(core("b", "cb"), "b", "left")
    bad = materialize(bad.where(~F.coalesce("ca", "a").eqNullSafe(F.coalesce("cb", "b"))).select("a", "b"), "bad")
    used = [buckets, judged, bad]
    if bad.isEmpty():
        discard(*used)
        return cores.withColumnRenamed("core", "cluster")
    pruned = bad.select(F.col("b").alias("node")).distinct()
    outside = likely(sets.select("node", "bands"), "node", pruned).join(pruned, "node", "left_semi").select("node", F.explode("bands").alias("band")).join(buckets.where("n > 2"), "band")
    outside = outside.join(bad.select(F.col("a").alias("least"), F.col("b").alias("node")), ["least", "node"], "left_semi")
    mixed = materialize(outside.groupBy("band").agg(F.any_value("least").alias("least"), F.any_value("n").alias("n"), F.count("*").alias("others")), "mixed")
    members = join_split(likely(banded, "band", mixed), mixed, "band", "inner", counts=mixed.select("band", "n"), spread="node")
    members = members.join(cores, "node", "left").withColumn("core", F.coalesce("core", "node"))
    members = members.join(core("least", "__c"), "least", "left").withColumn("out", F.col("core") != F.coalesce("__c", "least")).drop("__c")
    members = members.join(sets.select("node", "sig", "n_shingles"), "node")
    found = _across(members, percent)
    out = components(good.union(found)).withColumnRenamed("root", "cluster")
    discard(*used, mixed)
    return out


def _across(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links by signature between members of different cores of a bucket, enough of them to join what belongs together.

    Members outside the main core are cut into blocks, which meet each other, and the main core into blocks, which meet
    only those of the others. Tasks are sorted runs within partitions, so small buckets share one pass.
    """
    block = lambda n: F.pmod(F.xxhash64("node", F.lit(9)), F.greatest(F.ceil(n / BLOCK_DOCS), F.lit(1))).cast("int")
    span = lambda n: F.sequence(F.lit(0), F.greatest(F.ceil(n / BLOCK_DOCS), F.lit(1)).cast("int") - 1)
    b = members.withColumn("block", F.when(F.col("out"), block(F.col("others"))).otherwise(block(F.col("n") - F.col("others"))))
    pair = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    # (i, j) with j >= 0: blocks of others; j < 0: block i of others with block -1 - j of the main core
    to_others = F.transform(span(F.col("others")), lambda x: pair(F.least(x, F.col("block")), F.greatest(x, F.col("block")), F.when(x >= F.col("block"), 0).otherwise(1)))
    to_main = F.transform(span(F.col("n") - F.col("others")), lambda x: pair(F.col("block"), -1 - x, F.lit(0)))
    from_main = F.transform(span(F.col("others")), lambda x: pair(x, -1 - F.col("block"), F.lit(1)))
    sent = b.withColumn("t", F.explode(F.when(F.col("out"), F.concat(to_others, to_main)).otherwise(from_main)))
    sent = sent.select("band", "t.i", "t.j", "t.side", "node", "core", "sig", "n_shingles").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        task, rows = None, []

        def link() -> tuple[list, list]:
            names = [r[4] for r in rows]
            _, core = np.unique(np.array([r[5].hex() for r in rows]), return_inverse=True)
            sigs = np.frombuffer(b"".join([r[6] for r in rows]), np.uint8).reshape(-1, HASHES)
            side = np.array([r[3] for r in rows], np.int8) if task[1] != task[2] else np.zeros(len(rows), np.int8)
            roots = link_block(names, np.array([r[7] for r in rows], np.int64), sigs, None, side, percent, core)
            moved = np.flatnonzero((roots != np.arange(len(rows))) & (core[roots] != core))
            return [names[i] for i in roots[moved]], [names[i] for i in moved]

        for batch in batches:
            for r in zip(*[batch[c].to_pylist() for c in ("band", "i", "j", "side", "node", "core", "sig", "n_shingles")], strict=True):
                if r[:3] != task:
                    if len(rows) > 1 and len({x[5] for x in rows}) > 1:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in link()], schema=schema)
                    task, rows = r[:3], []
                rows.append(r)
        if len(rows) > 1 and len({x[5] for x in rows}) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in link()], schema=schema)
        give_back()

    return sent.mapInArrow(run, "a binary, b binary")


def _named(docs: DataFrame, words: int) -> DataFrame:
    """docs plus __node, the name of its text's set; null: no shingles."""

    def names(texts: pa.Array) -> pa.Array:
        sets = [shingles(t, words) for t in texts.to_pylist()]
        return pa.array([set_node(s) if len(s) else None for s in sets], pa.binary())

    return docs.withColumn("__node", F.arrow_udf(names, "binary")(text_or_empty()))


def _verify(docs: DataFrame, sets: DataFrame, clusters: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root): the components of the verified links within clusters."""
    # one row a node: the least document that has the set
    member = materialize(clusters.join(sets.select("node", "doc_id", "n_shingles", "sig"), "node"), "members")
    totals = member.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = member.join(totals, "cluster").withColumn("block", F.pmod(F.xxhash64("node", F.lit(9)), F.col("blocks")).cast("int"))
    # block i meets block j >= i in task (i, j); the documents of a block go to every task that it is part of
    tasks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    # sets of rows without an id only are found by their own name
    nameless = _named(docs.where("doc_id is null"), words).where("__node is not null").groupBy(F.col("__node").alias("node")).agg(F.min("text").alias("text"))
    columns = ("cluster", "blocks", "block", "node", "sig", "text")
    texts = placed.join(likely(docs, "doc_id", member.select("doc_id")), "doc_id").select(*columns).union(placed.where("doc_id is null").join(nameless, "node").select(*columns))
    sent = texts.withColumn("p", F.explode(tasks)).select("cluster", "p.i", "p.j", "block", "node", "sig", "text")

    def link(keys: tuple, t: pa.Table) -> pa.Table:
        names, sets, at, seen = t["node"].to_pylist(), [], [], set()
        for k, x in enumerate(t["text"]):
            s = shingles(x.as_py(), words)
            if names[k] not in seen and len(s) and set_node(s) == names[k]:  # a doc_id may have other texts too
                seen.add(names[k])
                at.append(k)
                sets.append(s)
        own = [names[k] for k in at]
        sigs = np.frombuffer(b"".join(t["sig"].take(at).to_pylist()), np.uint8).reshape(-1, HASHES)
        side = (t["block"].to_numpy()[at] == keys[2].as_py()).astype(np.int8) if keys[1].as_py() != keys[2].as_py() else np.zeros(len(at), np.int8)
        roots = link_block(own, np.array([len(s) for s in sets], np.int64), sigs, sets, side, percent)
        moved = np.flatnonzero(roots != np.arange(len(own)))
        return pa.table({"a": pa.array([own[k] for k in roots[moved]], pa.binary()), "b": pa.array([own[k] for k in moved], pa.binary())})

    out = components(sent.groupBy("cluster", "i", "j").applyInArrow(link, "a binary, b binary"))
    discard(member)
    return out


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of which one stays for each group of near copies (five-word shingles, 0.8), with their columns, whatever their names.

    It is a row of the least doc_id (nulls last). Where rows of that id or without an id are in the group more than once,
    one of them stays, the first by set and columns. Texts without shingles are in no group: one row stays for
    each id, and all rows without an id. Empty input: no rows.
    """
    found = materialize(_found(docs, 5, 80).select("doc_id", "node", "root", "kept"), "found")
    packed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    again = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    # most ids are in no group: only texts of ids that may go are moved to be held against those that do
    gone = materialize(found.where("doc_id is not null and not kept").select("doc_id").union(again).distinct(), "gone")
    told = possible(packed.where("doc_id is not null"), "doc_id", gone)
    once = told.where("not __maybe").select("__row.*").union(told.where("__maybe").join(gone, "doc_id", "left_anti").select("__row.*"))
    if again.isEmpty() and found.where("doc_id is null").isEmpty():
        return once
    # ids that repeat, and rows without one, are decided by id and set
    unclear = lambda df: df.join(again, "doc_id", "left_semi").select(df.columns).union(df.where("doc_id is null"))
    stay = unclear(found.where("kept")).groupBy("doc_id", "root").agg(F.min("node").alias("n")).select(F.col("doc_id").alias("__id"), F.col("n").alias("__n"))
    rows = _named(unclear(packed), 5)
    blank = rows.where("doc_id is null and __node is null").select("__row.*")
    rows = rows.where("doc_id is not null or __node is not null").join(stay, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("__node").eqNullSafe(F.col("__n")))
    first = W.partitionBy("doc_id", "__node").orderBy(F.to_json("__row"))
    return once.union(rows.withColumn("__r", F.row_number().over(first)).where("__r = 1").select("__row.*")).union(blank)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: two-word shingles, similarity 0.8; rows as near_duplicates gives them, nulls, repeats and empty tables too."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=2, percent=80)


ORACLE = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents where doc_id is not null),
s as (select distinct doc_id, unnest(case len(w) when 0 then [] when 1 then w else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as shingle from w),
n as (select w.doc_id, count(shingle) as n from w left join s using (doc_id) group by 1),
both_ as (select a.doc_id as a, b.doc_id as b, count(*) as both_ from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from both_ join n x on x.doc_id = a join n y on y.doc_id = b where 100 * both_ >= 80 * (x.n + y.n - both_)),
links as (select a, b from l union select b, a from l),
reach as (select doc_id, doc_id as other from n union select doc_id, b from reach join links on other = a)
select doc_id, any_value(n) as n_shingles, min(other) as component_id, doc_id = min(other) as kept from n join reach using (doc_id) group by doc_id
"""
