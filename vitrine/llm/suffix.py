"""Operator 5, suffix-array dedup: two-stage suffix sorting over the places where texts may repeat.

Suffix arrays (Itoh and Tanaka's two stages): suffixes smaller than their successors are sorted directly, in words of
eight bytes; all others are induced by one scan over the buckets of first characters; then the common prefixes of
neighbours are computed. Sorting and prefixes stop at WINDOW bytes, more is never asked.

Which bytes meet in one array: every window of WINDOW bytes chooses its anchor, the 64-gram of least hash in it (the first of
equal ones), so equal windows choose equal anchors, at the same offset. So anchors stand for all windows:
1. Every text is cut into pieces, runs of window starts whose anchors have one hash (about 69 starts), PIECE starts at most: hash, 128-bit
   digest of all bytes of the run's windows (its context), place. Each window is in one piece. Only text that repeats itself has long runs.
2. Pieces whose hash occurs once are done, but for runs over several anchors, which can repeat within themselves. Equal contexts of one
   hash are aggregated before they are sorted: all copies are repeats as a whole, and one of them stands for all.
3. The different contexts of a hash meet in a task, and suffix arrays over them find which of their windows occur at two places.
   Hashes whose contexts come to more than HOT_BYTES aren't gathered: their windows are counted by 128-bit digest in an ordinary
   aggregation instead, the exact way for what no one task should hold.
4. The spans of a text are united and cut out.

Scale: pieces, not windows, are shuffled; counting combines map-side; joins split hot hashes and contexts; texts are shuffled
twice, once to cut contexts out and once to apply spans. A task's array is bounded in bytes. No cap: every window that repeats is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, discard, join_split, materialize, table, text_or_empty

WINDOW, GRAM, PIECE, HOT_BYTES, CHUNK = 200, 64, 4096, 6_000_000, 1_500_000
REACH = WINDOW - GRAM  # how far before an anchor a window can start
BLOCK_BITS = 20  # positions within a block of window starts take so many of the low bits of a hash
SEPARATOR = 0xFF  # no byte of UTF-8
_MASK = (1 << 64) - 1
_TABLE = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.uint64(pow(_BASE, 1 << i, 1 << 64)) for i in range(6)]


def _slide(a: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) over every `width` neighbours."""
    step = 1
    while step * 2 <= width:
        a = best(a[:-step], a[step:])
        step *= 2
    return best(a[: len(a) - (width - step)], a[width - step :]) if width > step else a


def gram_hashes(data: np.ndarray) -> np.ndarray:
    h = _TABLE[data]
    for i, p in enumerate(_POWERS):
        h = h[: -(1 << i)] * p + h[1 << i :]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first start, number of starts, over several anchors) of the pieces of one text of at least WINDOW bytes."""
    starts, low = len(data) - WINDOW + 1, np.uint64((1 << BLOCK_BITS) - 1)
    step, out = (1 << BLOCK_BITS) - REACH, ([], [], [], [])
    for at in range(0, starts, step):
        n = min(step, starts - at)
        h = gram_hashes(data[at : at + n + WINDOW - 1])
        # hash and position in one number: the least is the first of the least
        chosen = _slide((h & ~low) | np.arange(len(h), dtype=np.uint64), REACH + 1, np.minimum) & low
        value = h[chosen]
        first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        count = np.diff(np.r_[first, n])
        if count.max() > PIECE:
            parts = -(-count // PIECE)
            rank = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            ends = np.repeat(first + count, parts)
            first = np.repeat(first, parts) + rank * PIECE
            count = np.minimum(PIECE, ends - first)
        for x, y in zip(out, (value[first].view(np.int64), first + at, count, chosen[first] != chosen[first + count - 1]), strict=True):
            x.append(y)
    return tuple(np.concatenate(x) for x in out)


def _piece_rows(batch: pa.RecordBatch) -> dict | None:
    parts, contexts, rows, counts = ([], [], [], []), [], [], []
    for k, text in enumerate(batch["text"]):
        raw = text.as_buffer()
        if raw is None or raw.size < WINDOW:
            continue
        raw = memoryview(raw)
        found = pieces(np.frombuffer(raw, np.uint8))
        contexts += [xxhash.xxh3_128_digest(raw[a : a + n + WINDOW - 1]) for a, n in zip(found[1].tolist(), found[2].tolist(), strict=True)]
        for p, x in zip(parts, found, strict=True):
            p.append(x)
        counts.append(len(found[0]))
        rows.append(k)
    if not rows:
        return None
    h, a, n, several = (np.concatenate(p) for p in parts)
    return {"h": h, "ctx": pa.array(contexts, pa.binary()), "key": batch["key"].take(pa.array(np.repeat(rows, counts))), "a": a.astype(np.int32), "n": n.astype(np.int32), "several": several}


# --- the suffix array ---------------------------------------------------------------------------------------------


def words8(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, 0 beyond the end."""
    padded = np.concatenate([t, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(t)].copy().view(">u8").ravel().astype(np.uint64)


def _sort_directly(at: np.ndarray, w: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of their suffixes' first `depth` bytes: rounds of eight bytes over those still tied."""
    n = len(w)
    at = at[np.argsort(w[at], kind="stable")]
    if len(at) < 2:
        return at
    key = w[at]
    group = np.cumsum(np.r_[0, key[1:] != key[:-1]])
    tied = np.arange(len(at))
    for r in range(8, depth, 8):
        same = group[1:] == group[:-1]
        live = np.r_[same, False] | np.r_[False, same]
        tied, group = tied[live], group[live]
        if not len(tied):
            break
        where = at[tied] + r
        key = np.where(where < n, w[np.minimum(where, n - 1)], np.uint64(0))
        o = np.lexsort((key, group))
        at[tied] = at[tied][o]
        key, group = key[o], group[o]
        group = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
    return at


def suffix_array(t: np.ndarray, depth: int = WINDOW, w: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of t in order of their first `depth` bytes (equal ones in any order), by two-stage sorting."""
    n = len(t)
    if n == 0:
        return np.empty(0, np.int64)
    w = words8(t) if w is None else w
    differs = np.flatnonzero(t[1:] != t[:-1])
    nxt = np.searchsorted(differs, np.arange(n))
    smaller = np.zeros(n, bool)  # than its successor
    inside = nxt < len(differs)
    d = differs[nxt[inside]]
    smaller[inside] = t[d] < t[d + 1]
    counts = np.bincount(t, minlength=256)
    start = np.r_[0, np.cumsum(counts)]
    sa = np.full(n, -1, np.int64)
    direct = _sort_directly(np.flatnonzero(smaller), w, depth)
    chars = t[direct]
    per = np.bincount(chars, minlength=256)
    offset = np.r_[0, np.cumsum(per)][:-1]
    sa[(start[1:] - per)[chars] + np.arange(len(direct)) - offset[chars]] = direct
    fill = start[:-1].copy()
    last = int(t[n - 1])
    sa[fill[last]] = n - 1
    fill[last] += 1
    for c in np.flatnonzero(counts).tolist():
        lo = int(start[c])
        while lo < fill[c]:  # a run of one character induces within its own bucket
            before = sa[lo : fill[c]] - 1
            lo = int(fill[c])
            before = before[before >= 0]
            before = before[~smaller[before] & (t[before] == c)]
            sa[lo : lo + len(before)] = before
            fill[c] += len(before)
        before = sa[start[c] : start[c + 1]] - 1
        before = before[before >= 0]
        before = before[~smaller[before]]
        to = t[before]
        before, to = before[to > c], to[to > c]
        if len(before):
            o = np.argsort(to, kind="stable")
            before, to = before[o], to[o]
            n_to = np.bincount(to, minlength=256)
            rank = np.arange(len(to)) - np.r_[0, np.cumsum(n_to)][:-1][to]
            sa[fill[to] + rank] = before
            fill += n_to
    return sa


def common_prefixes(sa: np.ndarray, w: np.ndarray, cap: int = WINDOW) -> np.ndarray:
    """Common prefix, in bytes up to cap, of each suffix in sa and the one before it (the first: 0)."""
    n, out = len(w), np.zeros(len(sa), np.int64)
    live = np.arange(1, len(sa))
    for r in range(0, cap, 8):
        a, b = sa[live] + r, sa[live - 1] + r
        x = np.where(a < n, w[np.minimum(a, n - 1)], np.uint64(0)) ^ np.where(b < n, w[np.minimum(b, n - 1)], np.uint64(1))
        same = x == 0
        lead = np.zeros(len(x), np.int64)
        for k in range(1, 8):
            lead += (x >> np.uint64(64 - 8 * k)) == 0
        out[live] = np.minimum(r + np.where(same, 8, lead), np.minimum(cap, n - np.maximum(sa[live], sa[live - 1])))
        live = live[same]
        if not len(live):
            break
    return out


def repeated_windows(texts: list[bytes], owners: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, end): united spans of the windows that occur at two or more places of the owners' texts.

    Each given text is a part of its owner's from the offset on. Parts may overlap; one place counts once.
    """
    lengths = np.array([len(x) for x in texts], np.int64)
    t = np.frombuffer(b"".join(x + b"\xff" for x in texts), np.uint8)
    begin = np.r_[0, np.cumsum(lengths + 1)][:-1]
    part = np.repeat(np.arange(len(texts)), lengths + 1)
    w = words8(t)
    sa = suffix_array(t, WINDOW, w)
    sa = sa[sa + WINDOW <= (begin + lengths)[part[sa]]]
    if len(sa) < 2:
        return (np.empty(0, np.int64),) * 3
    equal = common_prefixes(sa, w)[1:] >= WINDOW
    _, number = np.unique(owners, return_inverse=True)
    place = number[part[sa]] << 40 | (offsets[part[sa]] + sa - begin[part[sa]])
    first = np.flatnonzero(np.r_[True, ~equal])
    size = np.diff(np.r_[first, len(sa)])
    found = np.repeat(np.minimum.reduceat(place, first) != np.maximum.reduceat(place, first), size)
    at = np.sort(sa[found])
    if not len(at):
        return (np.empty(0, np.int64),) * 3
    new = np.r_[True, (np.diff(at) > WINDOW) | (part[at[1:]] != part[at[:-1]])]
    a, b = at[new], at[np.r_[np.flatnonzero(new)[1:], len(at)] - 1] + WINDOW
    p = part[a]
    return owners[p], offsets[p] + a - begin[p], offsets[p] + b - begin[p]


# --- Spark --------------------------------------------------------------------------------------------------------


def _cut(batch: pa.RecordBatch) -> dict | None:
    """The contexts of a text's chosen pieces."""
    out = {k: [] for k in ("h", "hot", "key", "at", "bytes")}
    for key, text, chosen in zip(batch["key"].to_pylist(), batch["text"], batch["chosen"].to_pylist(), strict=True):
        raw = text.as_buffer().to_pybytes()
        for c in chosen:
            for k, v in (("h", c["h"]), ("hot", c["hot"]), ("key", key), ("at", c["a"]), ("bytes", raw[c["a"] : c["a"] + c["n"] + WINDOW - 1])):
                out[k].append(v)
    return out if out["h"] else None


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of h: suffix arrays over whole hashes, about CHUNK bytes each, at most CHUNK + HOT_BYTES."""
    rows: list[tuple] = []
    size, previous = 0, None
    schema = pa.schema([("key", pa.binary()), ("a", pa.int32()), ("b", pa.int32())])

    def flush() -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        owners = np.array([number.setdefault(r[0], len(number)) for r in rows], np.int64)
        owner, a, b = repeated_windows([r[2] for r in rows], owners, np.array([r[1] for r in rows], np.int64))
        keys = pa.array(list(number), pa.binary()).take(pa.array(owner))
        return pa.RecordBatch.from_arrays([keys, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], schema=schema)

    for batch in batches:
        for h, key, at, data in zip(batch["h"].to_pylist(), batch["key"].to_pylist(), batch["at"].to_pylist(), batch["bytes"].to_pylist(), strict=True):
            if h != previous and size >= CHUNK:
                yield flush()
                rows, size = [], 0
            previous = h
            rows.append((key, at, data))
            size += len(data)
    if rows:
        yield flush()


def _windows(batch: pa.RecordBatch) -> dict:
    """Each window of a hot hash, by digest."""
    d, keys, at = [], [], []
    for key, a, raw in zip(batch["key"].to_pylist(), batch["at"].to_pylist(), batch["bytes"].to_pylist(), strict=True):
        for i in range(len(raw) - WINDOW + 1):
            d.append(xxhash.xxh3_128_digest(raw[i : i + WINDOW]))
            keys.append(key)
            at.append(a + i)
    return {"digest": d, "key": keys, "a": at}


def repeated_spans(keyed: DataFrame, *, hot: int = HOT_BYTES) -> DataFrame:
    """(key, a, b): byte spans covered by windows that occur at two or more places. keyed: (key binary, text); equal keys mean equal rows."""
    found = materialize(arrow_map(keyed.select("key", "text"), _piece_rows, "h long, ctx binary, key binary, a int, n int, several boolean"), "pieces")
    often = found.groupBy("h").agg(F.count("*").alias("n"), F.max("several").alias("several")).where("n > 1 or several").select("h", "n")
    often = materialize(often, "often")
    again = materialize(join_split(found, often.select("h"), "h", "left_semi", counts=often, spread="key"), "again")
    kinds = again.groupBy("h", "ctx").agg(F.count("*").alias("copies"), F.min(F.struct("key", "a", "n", "several")).alias("one"))
    kinds = materialize(kinds.select("h", "ctx", "copies", "one.*"), "kinds")
    copied = kinds.where("copies > 1").select("h", "ctx", F.col("copies").alias("n"))
    whole = join_split(again, copied.select("h", "ctx"), ["h", "ctx"], "left_semi", counts=copied, spread="key").select("key", "a", (F.col("a") + F.col("n") + F.lit(WINDOW - 1)).alias("b"))
    groups = kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.sum(F.col("n") + F.lit(WINDOW)).alias("bytes")).where("kinds > 1")
    alone = F.col("kinds").isNull() & (F.col("copies") == 1) & F.col("several")
    chosen = kinds.join(groups, "h", "left").where(F.col("kinds").isNotNull() | alone).select("key", F.struct("h", F.coalesce(F.col("bytes") > hot, F.lit(False)).alias("hot"), "a", "n").alias("c"))
    lists = chosen.groupBy("key").agg(F.collect_list("c").alias("chosen"))
    parts = arrow_map(keyed.join(lists, "key").select("key", "text", "chosen"), _cut, "h long, hot boolean, key binary, at int, bytes binary")
    parts = materialize(parts, "contexts")
    searched = parts.where("not hot").select("h", "key", "at", "bytes").repartition("h").sortWithinPartitions("h").mapInArrow(_search, "key binary, a int, b int")
    single = materialize(arrow_map(parts.where("hot").select("key", "at", "bytes"), _windows, "digest binary, key binary, a int"), "windows")
    twice = single.groupBy("digest").agg(F.min(F.struct("key", "a")).alias("x"), F.max(F.struct("key", "a")).alias("y")).where("x <> y").select("digest")
    counted = single.join(twice, "digest", "left_semi").select("key", "a", (F.col("a") + WINDOW).alias("b"))
    spans = materialize(whole.unionByName(searched).unionByName(counted), "spans")
    discard(found, often, again, kinds, parts, single)
    return spans


def _apply(batch: pa.RecordBatch) -> dict:
    out = {"doc_id": batch["doc_id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
    for text, spans in zip(batch["text"], batch["spans"].to_pylist(), strict=True):
        raw = text.as_buffer().to_pybytes()
        kept, at, removed, n = [], 0, 0, 0
        end = -1
        for s in sorted((s["a"], s["b"]) for s in spans or ()):
            a, b = s[0], min(s[1], len(raw))
            if a > end:
                n += 1
                kept.append(raw[at:a])
                removed += b - a
                end = at = b
            elif b > end:
                removed += b - end
                end = at = b
        kept.append(raw[at:])
        for k, v in (("n_bytes", len(raw)), ("n_removed", removed), ("n_spans", n), ("kept_sha256", hashlib.sha256(b"".join(kept)).hexdigest())):
            out[k].append(v)
    return out


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one for each input row.

    docs needs doc_id (long) and text; more columns are ignored. Null texts are empty; texts under WINDOW bytes keep
    all. Rows repeated as a whole are each other's copies. Rows with one doc_id and different texts are told
    apart. Null doc_ids stay null. Empty input: no rows.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    keyed = keyed.select(F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), "text"))).alias("key"), "doc_id", "text")
    spans = repeated_spans(keyed, **options).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    return arrow_map(keyed.join(spans, "key", "left").select("doc_id", "text", "spans"), _apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; null texts are as empty, repeated rows are copies of each other, no rows for an empty table."""
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
