"""Operator 13, approximate nearest neighbours by inner product: stable projections, a kd-tree over them, a chi-square stopping test.

Largest inner product becomes least distance: with M the greatest norm, a row x gets one more component sqrt(M^2 - |x|^2), a query 0, and
the squared distance is |q|^2 + M^2 - 2 <q, x>. Rows and queries are projected to DIMS dimensions by a Gaussian (2-stable) matrix: of two
points at distance d, the squared projected distance over d^2 is chi-square with DIMS degrees of freedom. A kd-tree over the projections
yields a query's neighbours in them cell by cell, nearest cell first, and verifies them by their original vectors. Once the chance that a row
as near as the k-th verified one lies within what is left unseen is small, that is once chi-square(bound^2 / d_k^2) reaches
CONFIDENCE for the nearest cell left, the query stops. So each true neighbour is found with a chance of at least CONFIDENCE.

The tree's planes are fitted on a sample of about SAMPLE rows by hash; every row is indexed. It has at most 2 ** MAX_DEPTH cells, whose boxes are
the bounds of the rows that they hold.

Scale: rows with one vector are one entry with its k + 1 least ids, and queries with one vector are one query, so a vector that a third of all rows
share costs nothing extra. A cell's rows are split into parts of about PART_ROWS, its questions into parts of about QUERY_ROWS, and a task verifies one part
against another as matrix products. Cells are asked in rounds that grow fourfold, so there are at most 2 + MAX_DEPTH / 2 of them. Only
planes, boxes and counts of cells, at most 2 ** MAX_DEPTH rows, are broadcast or reach the driver. Where neighbours are far, as random vectors' are, the
test covers a large share of all cells: what is verified grows with queries times rows, what is sent with queries times parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import discard, join_split, materialize, table

DIMS, CONFIDENCE, SEED = 12, 0.95, 13
SAMPLE, LEAF_ROWS, MAX_DEPTH = 8_192, 1_024, 10
PART_ROWS, QUERY_ROWS = 4_096, 4_096
RESULT = "query_id long, rank int, vec_id long, score double"


def chi_square(x: float, dims: int = DIMS) -> float:
    """Distribution function of chi-square with an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def stop_factor(confidence: float = CONFIDENCE, dims: int = DIMS) -> float:
    """The x at which chi_square reaches the confidence: the test holds for a bound b once b^2 >= x * d_k^2."""
    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dims) < confidence else (low, middle)
    return high


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


@dataclass
class Tree:
    """Planes of a complete kd-tree of a given depth, node 0 the root, children of i at 2 i + 1 and 2 i + 2."""

    depth: int
    axis: np.ndarray
    value: np.ndarray

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - (2**self.depth - 1)


def fit_tree(points: np.ndarray, depth: int) -> Tree:
    """Planes at the median of the axis on which a node's points spread most."""
    axis, value = np.zeros(2**depth - 1, np.int64), np.zeros(2**depth - 1)
    held = {0: points}
    for node in range(2**depth - 1):
        here = held.pop(node)
        if len(here):
            axis[node] = np.argmax(here.var(axis=0))
            value[node] = np.median(here[:, axis[node]])
        right = here[:, axis[node]] > value[node]
        held[2 * node + 1], held[2 * node + 2] = here[~right], here[right]
    return Tree(depth, axis, value)


@dataclass
class Space:
    """What turns vectors into projections: dimension, greatest squared norm, number of projections."""

    dim: int
    top: float
    dims: int = DIMS

    def project(self, x: np.ndarray, *, query: bool) -> np.ndarray:
        plane = np.random.default_rng(SEED).standard_normal((self.dim + 1, self.dims))
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top - np.einsum("ij,ij->i", x, x), 0))
        return x @ plane[:-1] + last[:, None] * plane[-1]


def _placed(space: Space, tree: Tree | None):
    """mapInArrow: (vector, ids) to (vector, ids, cell, projection)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = space.project(_matrix(batch.column(0), space.dim), query=False)
                cell = tree.cells(p) if tree else np.zeros(len(p), np.int64)
                shown = pa.ListArray.from_arrays(np.arange(0, p.size + 1, space.dims, dtype=np.int32), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell), shown], names=["vector", "ids", "cell", "p"])

    return run


def _asks(space: Space, low: np.ndarray, high: np.ndarray, number: np.ndarray, skip: int, take: int, factor: float, block: int = 256):
    """mapInArrow: (q, vector, kth) to (q, vector, kth, cell), the cells in places skip to skip + take of the order by their bound, as far as the test asks for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, block):
                part = batch.slice(i, block)
                x = _matrix(part.column(1), space.dim)
                p = space.project(x, query=True)
                bound = sum((np.maximum(np.maximum(low[None, :, j] - p[:, None, j], p[:, None, j] - high[None, :, j]), 0) ** 2 for j in range(space.dims)), np.zeros((len(x), len(low))))
                order = np.argsort(bound, axis=1, kind="stable")[:, skip : skip + take]
                kth = part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN, fewer than k + 1 found
                d2 = np.einsum("ij,ij->i", x, x) + space.top - 2 * kth
                reach = np.where(np.isnan(d2), np.inf, factor * np.maximum(d2, 0))
                row, place = np.nonzero(np.take_along_axis(bound, order, 1) <= reach[:, None])
                picked = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(number[order[row, place]])], names=["q", "vector", "kth", "cell"])

    return run


def _chunk(dtype: str):
    """applyInArrow: the rows of a part as one row, with vectors and ids as bytes."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        x = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(dtype)
        ids = rows.column("ids").combine_chunks()
        of = np.repeat(np.arange(len(ids)), ids.value_lengths().to_numpy(zero_copy_only=False))
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<i8")
        return pa.table({"cell": [key[0].as_py()], "part": [key[1].as_py()], "vectors": [x.tobytes()], "ids": [flat.tobytes()], "entry": [of.astype("<i4").tobytes()]}, schema=pa.schema([("cell", pa.int64()), ("part", pa.int32()), ("vectors", pa.binary()), ("ids", pa.binary()), ("entry", pa.binary())]))

    return run


def _verify(dim: int, dtype: str, want: int, block: int = 256):
    """Cogrouped applyInArrow: a part's entries against the queries that ask for it; of each query the nearest `want` ids.

    A matrix product picks the entries that may be among them; their measure is then summed component by component in double precision,
    so it doesn't depend on what else is in the part.
    """

    def run(index: pa.Table, asks: pa.Table) -> pa.Table:
        out: dict[str, list] = {"q": [], "neg": [], "id": []}
        for r in range(index.num_rows if asks.num_rows else 0):
            x = np.frombuffer(index.column("vectors")[r].as_py(), dtype).astype(np.float64).reshape(-1, dim)
            ids = np.frombuffer(index.column("ids")[r].as_py(), "<i8")
            entry = np.frombuffer(index.column("entry")[r].as_py(), "<i4")
            first = np.searchsorted(entry, np.arange(len(x)))
            size = np.bincount(entry, minlength=len(x))
            longest = np.sqrt(np.einsum("ij,ij->i", x, x).max())
            queries, kth = asks.column("q").to_numpy(), asks.column("kth").to_numpy().astype(np.float64)
            vectors = _matrix(asks.column("vector").combine_chunks(), dim)
            for i in range(0, len(queries), block):
                v = vectors[i : i + block]
                near = v @ x.T
                slack = 1e-9 * longest * np.sqrt(np.einsum("ij,ij->i", v, v))
                least = np.full(len(v), -np.inf) if len(x) <= want else np.partition(near, len(x) - want, axis=1)[:, len(x) - want]
                row, col = np.nonzero(near >= (np.fmax(least, kth[i : i + block]) - slack)[:, None])
                score = np.zeros(len(row))
                for j in range(dim):
                    score += v[row, j] * x[col, j]
                times = size[col]
                at = np.repeat(first[col], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                q, neg, found = np.repeat(row, times), np.repeat(-score, times), ids[at]
                by = np.lexsort((found, neg, q))
                q, neg, found = q[by], neg[by], found[by]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                kept = place < want
                out["q"].append(queries[i : i + block][q[kept]])
                out["neg"].append(neg[kept])
                out["id"].append(found[kept])
        types = {"q": np.int64, "neg": np.float64, "id": np.int64}
        return pa.table({n: np.concatenate(parts) if parts else np.zeros(0, types[n]) for n, parts in out.items()})

    return run


def nearest(rows: DataFrame, queries: DataFrame, k: int, *, confidence: float = CONFIDENCE, leaf_rows: int = LEAF_ROWS, part_rows: int = PART_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found by inner product, the query's own id left out, ties to the smaller id.

    rows, queries: (id, vector); more columns are ignored. Null ids, and vectors that are null, zero or hold null or non-finite
    components, take no part, nor do vectors of another length than most rows have (of lengths equally frequent the longest counts). Rows
    repeated as a whole count once. Fewer than k other rows: all of them. No rows or no queries: no result.
    """
    spark, want = rows.sparkSession, k + 1  # a query's own row may be among its nearest
    single = isinstance(rows.schema["vector"].dataType.elementType, FloatType)
    kind, dtype = ("array<float>", "<f4") if single else ("array<double>", "<f8")
    clean = lambda df, name: df.select(F.col("id").cast("long").alias(name), F.col("vector").cast(kind).alias("vector")).where(F.col(name).isNotNull() & usable(F.col("vector")))
    rows, queries = clean(rows, "id"), clean(queries, "query_id")
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("c")).orderBy(F.col("c").desc(), F.col("n").desc()).first()
    if lengths is None:
        return spark.createDataFrame([], RESULT)
    dim = lengths.n
    rows, queries = rows.where(F.size("vector") == dim), queries.where(F.size("vector") == dim)
    few = rows.distinct().withColumn("r", F.row_number().over(W.partitionBy("vector").orderBy("id"))).where(F.col("r") <= want)
    entries = materialize(few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    norm2 = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sizes = entries.agg(F.count("*").alias("n"), F.max(norm2).alias("top")).first()
    space = Space(dim, sizes.top)
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(sizes.n / leaf_rows))))
    tree = None
    if depth:
        share = min(1.0, SAMPLE / sizes.n)
        picked = entries.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 30)) < int(share * (1 << 30))).select("vector").toArrow()  # about SAMPLE rows
        tree = fit_tree(space.project(_matrix(picked.column(0).combine_chunks(), dim), query=False), depth)
    placed = materialize(entries.mapInArrow(_placed(space, tree), f"vector {kind}, ids array<long>, cell long, p array<double>"), "placed")
    bounds = [f(F.col("p")[j]).alias(f"{n}{j}") for n, f in (("low", F.min), ("high", F.max)) for j in range(space.dims)]
    cells = placed.groupBy("cell").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"), *bounds)
    cells = materialize(cells, "cells")  # at most 2 ** MAX_DEPTH rows
    boxes = cells.toArrow()
    number = boxes.column("cell").to_numpy()
    low, high = (np.stack([boxes.column(f"{n}{j}").to_numpy() for j in range(space.dims)], axis=1) for n in ("low", "high"))
    parts = F.broadcast(cells.select("cell", "parts"))
    part = F.pmod(F.xxhash64("vector", F.lit(3)), F.col("parts")).cast("int").alias("part")
    index = placed.join(parts, "cell").select("cell", part, "vector", "ids").groupBy("cell", "part").applyInArrow(_chunk(dtype), "cell long, part int, vectors binary, ids binary, entry binary")
    index = materialize(index, "index")
    state = queries.groupBy("vector").agg(F.min("query_id").alias("q")).select("q", "vector", F.lit(None).cast("double").alias("kth"), F.array().cast("array<struct<neg:double,id:bigint>>").alias("found"))
    state = materialize(state, "state")
    used, skip, take, factor = [entries, placed, cells, index], 0, 1, stop_factor(confidence)
    while skip < len(number):
        asks = materialize(state.select("q", "vector", "kth").mapInArrow(_asks(space, low, high, number, skip, take, factor), f"q long, vector {kind}, kth double, cell long"), "asks")
        used.append(asks)
        deals = asks.groupBy("cell").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("deals"))
        deals = F.broadcast(materialize(deals.join(parts, "cell"), "deals"))  # at most 2 ** MAX_DEPTH rows
        deal = F.pmod(F.xxhash64("q", F.lit(4)), F.col("deals")).cast("int").alias("deal")
        each = asks.join(deals, "cell").select("cell", deal, "q", "vector", "kth", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        copies = index.join(deals.drop("parts"), "cell").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1))).drop("deals")
        met = copies.groupBy("cell", "part", "deal").cogroup(each.groupBy("cell", "part", "deal")).applyInArrow(_verify(dim, dtype, want), "q long, neg double, id long")
        # of each partition's findings only a query's nearest are sent
        best = met.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy("neg", "id"))).where(F.col("r") <= want)
        best = best.groupBy("q").agg(F.collect_list(F.struct("neg", "id")).alias("more"))
        found = F.slice(F.array_sort(F.concat("found", F.coalesce("more", F.expr("cast(array() as array<struct<neg:double,id:bigint>>)")))), 1, want)
        joined = state.join(best, "q", "left").select("q", "vector", found.alias("found"))
        used.append(state)
        state = materialize(joined.withColumn("kth", F.when(F.size("found") >= want, -F.element_at("found", -1)["neg"])), "state")
        skip, take = skip + take, take * 4
    discard(*used)
    own = join_split(queries.distinct(), state.select("vector", "found"), "vector", "inner", counts=queries.distinct().groupBy("vector").agg(F.count("*").alias("n")), spread="query_id")
    own = own.select("query_id", F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("p", "x")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (F.lit(0.0) - F.col("x.neg")).alias("score"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every row of embeddings whose id is divisible by 20, against all rows; k = 20. Nulls, repeats and empty tables as nearest() has them."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return nearest(rows, rows.where("id % 20 = 0"), 20)
