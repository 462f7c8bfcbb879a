"""Operator 1, exact top-k search: incremental multi-index hashing over 64-bit binary codes.

A code is cut into segments, each with an index of its own: rows keyed by (segment, value). A query probes the values within a
radius of its own in each segment, radius by radius. Once radius r is searched in segments 0 to j and r - 1 in the others, every
code within distance m * r + j is found (pigeonhole over m segments), so a probe is sent only while the k-th verified
distance isn't below that; it is carried from round to round, and no query is asked again once it is covered.

Scale: rows with one code count once (only their k + 1 least ids can matter), as do queries with one code, so a code that a third
of all rows share costs nothing extra. An index row holds the entries of one key, at most about PART_ROWS of them; a hot value is
several rows. A round joins probes with index rows by key, and each of these meetings verifies its entries in place and gives at most k + 1
nearest, so rows grow with the queries and not with queries times entries. The one thing broadcast is the directory of keys: at
most SEGMENTS * 2 ** (64 / SEGMENTS) rows, whatever the input. With n codes, segments of about log2(n) bits keep a key's entries few: 8
segments up to some million codes, 4 beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, materialize, table

SEGMENTS = 8
PART_ROWS = 4096


def sign_code(embedding: Column) -> Column:
    """64-bit code of a vector: bit i is set where component i is above 0 (null or NaN: not set). Null vector: null.

    A vector of more than 64 components fails the query: a code of its first 64 would rank by a part of it.
    """
    bits = F.transform(embedding, lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    code = F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(embedding) > 64, F.raise_error(F.lit("a 64-bit sign code does not hold a vector of more than 64 components")).cast("bigint")).otherwise(code)


def _segment(code: Column, j: Column, bits: int) -> Column:
    return F.call_function("shiftrightunsigned", code, (j * bits).cast("int")).bitwiseAND(F.lit((1 << bits) - 1))


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("long")


def topk(rows: DataFrame, queries: DataFrame, k: int, *, segments: int = SEGMENTS, part_rows: int = PART_ROWS) -> DataFrame:
    """The k nearest rows of each query by (Hamming distance, id), the query's own id left out.

    rows, queries: (id long, code long); more columns are ignored. Null ids or codes take no part: such
    rows are never found and such queries get no row. Rows repeated as a whole count once. Fewer than k
    other rows: all of them. Empty input: no rows. Returns (query_id, rank, neighbor_id, distance).
    """
    if segments not in (4, 8):
        raise ValueError("4 or 8 segments")
    bits, want = 64 // segments, k + 1  # a query's own row may be among its nearest
    rows = rows.select(F.col("id").cast("long"), F.col("code").cast("long")).where("id is not null and code is not null")
    queries = queries.select(F.col("id").cast("long").alias("query_id"), F.col("code").cast("long")).where("query_id is not null and code is not null").distinct()
    few = rows.distinct().withColumn("r", F.row_number().over(W.partitionBy("code").orderBy("id"))).where(F.col("r") <= want)
    codes = materialize(few.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "codes")
    split = lambda c: F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(segments - 1)), lambda j: _segment(c, j, bits)))
    entries = codes.select("code", "ids", split(F.col("code")).alias("seg", "value"))
    directory = entries.groupBy("seg", "value").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    directory = materialize(directory, "directory")  # at most segments * 2 ** bits rows
    part = F.pmod(F.xxhash64("code", F.lit(5)), F.col("parts")).cast("int")
    placed = entries.join(F.broadcast(directory), ["seg", "value"]).withColumn("part", part)
    index = materialize(placed.groupBy("seg", "value", "part").agg(F.collect_list(F.struct("code", "ids")).alias("entries")), "index")
    start = F.array().cast("array<struct<distance:bigint,id:bigint>>")
    state = materialize(queries.select(F.col("code").alias("q")).distinct().select("q", start.alias("found"), F.lit(64).cast("long").alias("kth")), "state")
    used = [codes, directory, index]
    for radius in range(bits + 1):
        # all codes within segments * radius - 1 are found
        active = state.where(F.col("kth") >= segments * radius)
        if active.isEmpty():
            break
        masks = F.filter(F.sequence(F.lit(0).cast("long"), F.lit((1 << bits) - 1).cast("long")), lambda m: F.bit_count(m) == radius)  # noqa: B023
        probes = active.select("q", "kth", split(F.col("q")).alias("seg", "own")).where(F.col("kth") >= segments * radius + F.col("seg"))
        probes = probes.select("q", "kth", "seg", F.col("own").alias("own"), F.explode(masks).alias("mask")).withColumn("value", F.col("own").bitwiseXOR(F.col("mask")))
        probes = probes.join(F.broadcast(directory), ["seg", "value"]).select("q", "kth", "seg", "value", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        met = probes.join(index, ["seg", "value", "part"])
        close = F.filter("entries", lambda e: _distance(F.col("q"), e["code"]) <= F.col("kth"))
        # of codes at one distance the least id comes first, so the nearest k + 1 codes hold the nearest k + 1 rows
        top = F.slice(F.array_sort(F.transform(close, lambda e: F.struct(_distance(F.col("q"), e["code"]).alias("distance"), e["ids"].alias("ids")))), 1, want)
        near = met.select("q", F.explode(top).alias("x")).select("q", F.explode(F.transform("x.ids", lambda i: F.struct(F.col("x.distance").alias("distance"), i.alias("id")))).alias("x"))
        both = near.unionByName(active.select("q", F.explode("found").alias("x")))
        found = both.groupBy("q").agg(F.slice(F.array_sort(F.collect_set("x")), 1, want).alias("found"))  # a pair may meet at several keys
        kth = F.when(F.size("found") >= want, F.element_at("found", -1)["distance"]).otherwise(F.lit(64).cast("long"))
        left = active.select("q").join(found, "q", "left").select("q", F.coalesce("found", start).alias("found"))
        following = state.where(F.col("kth") < segments * radius).unionByName(left.withColumn("kth", kth))
        used.append(state)
        state = materialize(following.select("q", "found", "kth"), "state")
    discard(*used)
    own = queries.join(state.select(F.col("q").alias("code"), "found"), "code").select("query_id", F.filter("found", lambda x: x["id"] != F.col("query_id")).alias("found"))
    return own.select("query_id", F.posexplode(F.slice("found", 1, k)).alias("p", "x")).select("query_id", (F.col("p") + 1).cast("long").alias("rank"), F.col("x.id").alias("neighbor_id"), F.col("x.distance").alias("distance"))


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: every row of embeddings whose id is divisible by 20, against all rows; k = 10, sign codes. Null vectors take no part."""
    coded = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code"))
    return topk(coded, coded.where("id % 20 = 0"), 10)


ORACLE = """
with c as (select vec_id as id, list_transform(embedding, lambda x: case when x > 0 and not isnan(x) then 1 else 0 end) as bits from embeddings where embedding is not null and vec_id is not null),
p as (select q.id as query_id, r.id as neighbor_id, list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: abs(z[1] - z[2])))::bigint as distance
      from c q join c r on q.id % 20 = 0 and q.id <> r.id),
k as (select query_id, row_number() over (partition by query_id order by distance, neighbor_id) as rank, neighbor_id, distance from p)
select query_id, rank, neighbor_id, distance from k where rank <= 10
"""
