"""Operator 6, mixing sources to target weights: weighted fair queueing over shuffled documents.

Each document of a source stands in a queue in shuffled order (by a hash of its id) and is served up to
`epochs` times. Its virtual finish time is the source's cumulative words divided by the source's target;
copies of later epochs follow the whole source. Serving all queues in order of finish time until the
budget is spent gives every source its target, to within one document.

Scale: no source is ever one group. Cumulative sums are taken in two levels: over (source, slot of the
hash), then within a slot, so a source with a third of all rows is spread over all its slots. The global
order is a range sort that stops where the budget ends: words are summed by range of finish time, the range that holds
the end is cut into as many ranges again, and only the rows of the one of these that holds the end (one in eight million of the
corpus) are sorted by row; all ranges before it are taken whole. Of documents only ids and sizes are queued: texts are compared with
their source's bound where they lie, a join that Spark broadcasts while the sources are few and splits by itself where one is hot. What meets in one task are one row for each source, for
each slot of a source or for each range.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, materialize, table, text_or_empty

SLOT_DIGITS, RANGES = 3, 4096
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, *, share: float = 1.5, epochs: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from rows (source, size): weights by code point order of the source, null last.

    Targets are the share of all sizes split by weight, where no target passes epochs * source_size; the
    excess goes to the others by weight. The fixed point is min(cap, level * weight), whose level follows
    from prefix sums over the sources in order of cap / weight. One row a source meets in one task.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = by.withColumn("i", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("i") % len(weights)) + 1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    up = W.orderBy(F.col("cap") / F.col("w"), "i")
    x = ordered.select("source", "source_size", "i", weight.alias("w"), (F.col("source_size") * float(epochs)).alias("cap"))
    x = x.withColumns({"budget": F.sum("source_size").over(every) * share, "capped": F.coalesce(F.sum("cap").over(up.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)), "rest": F.sum("w").over(up.rowsBetween(0, W.unboundedFollowing))})
    # the level if all before this source are capped and none from here on; the least source that it does not cap has it
    x = x.withColumn("level", (F.col("budget") - F.col("capped")) / F.col("rest"))
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "i", "level"))).over(every)
    x = x.withColumn("l", level.getField("level"))
    return x.select("source", "source_size", F.coalesce(F.least("cap", F.col("l") * F.col("w")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, *, share: float = 1.5, epochs: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """docs (doc_id, source, size long, any more) plus source_size, target and taken (words taken, repeats counted).

    Null sizes count 0; documents of size 0 take 0. A null source is a source of its own, last in order; null ids share one place in
    the order. Rows repeated as a whole are rows of their own and queue side by side. Empty input: no rows.
    Input columns named source_size, target or taken are replaced, all others stay whatever their names. The order is a
    function of doc_id and seed, so reruns agree.
    """
    size = F.coalesce(F.col("size").cast("long"), F.lit(0).cast("long"))
    out = _queue(docs.select(F.struct("*").alias("row"), "doc_id", "source", size.alias("size")), share=share, epochs=epochs, weights=weights, seed=seed)
    keep = [F.col("size") if c == "size" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("source_size", "target", "taken")]
    return out.select(*keep, "source_size", "target", "taken")


def _queue(docs: DataFrame, *, sizes: DataFrame | None = None, share: float = 1.5, epochs: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """docs of exactly (row, doc_id, source, size), row holding what the caller wants back, plus source_size, target and taken.

    sizes: the (doc_id, source, size) of docs as a table, where those of docs cost a reading of its texts. Only it is queued: what
    each source has served when the budget ends is the first rows of its order, so docs' own rows meet one bound a source and epoch.
    """

    def keyed(df: DataFrame) -> DataFrame:
        key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
        return df.withColumns({"key": key, "name": _name("source")})

    place = F.struct("key", "doc_id", "size")
    rows = keyed(docs)
    sizes = keyed(docs.select("doc_id", "source", "size") if sizes is None else sizes).withColumn("slot", F.substring("key", 1, SLOT_DIGITS))
    slots = materialize(sizes.groupBy("source", "name", "slot").agg(F.sum("size").alias("size")), "slots")
    targets = materialize(source_targets(slots, share=share, epochs=epochs, weights=weights).withColumn("name", _name("source")).drop("source"), "targets")
    heads = slots.select("name", "slot", (F.sum("size").over(W.partitionBy("name").orderBy("slot")) - F.col("size")).alias("before")).join(targets, "name")
    within = W.partitionBy("name", "slot").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    timed = sizes.withColumn("inside", F.sum("size").over(within)).join(heads, ["name", "slot"]).where("size > 0 and target > 0")
    timed = materialize(timed.select("name", "key", "doc_id", "size", (F.col("before") + F.col("inside")).alias("upto"), "source_size", "target"), "timed")
    times = F.array(*[F.struct(((F.col("upto") + F.col("source_size") * e) / F.col("target")).alias("f"), F.lit(e).alias("e")) for e in range(epochs)])
    served = timed.select("name", "key", "doc_id", "size", F.explode(times).alias("x")).select("name", "key", "doc_id", "size", "x.f", "x.e")
    # every finish time up to 1 is within a target and the targets sum to the budget: ranges split (0, 2) evenly, the rest is one
    ranged = served.withColumn("range", F.least(F.floor(F.col("f") * (RANGES // 2)), F.lit(RANGES)).cast("int"))
    budget = targets.agg(F.floor(F.sum("target") + 0.5).cast("long").alias("budget"))
    every = W.orderBy("range")

    def edge_of(rows: DataFrame, spent: DataFrame) -> DataFrame:
        """(range, spent, budget): of at most RANGES + 1 ranges the one in which the budget ends, and what is spent before it; no row: it doesn't."""
        sums = rows.groupBy("range").agg(F.sum("size").alias("words")).crossJoin(F.broadcast(spent))  # one row
        sums = sums.withColumn("upto", F.col("spent") + F.sum("words").over(every)).where(F.col("upto") > F.col("budget"))
        return sums.agg(F.min(F.struct("range", (F.col("upto") - F.col("words")).alias("spent"), "budget")).alias("m")).select("m.*").where("range is not null")

    first = materialize(edge_of(ranged, budget.withColumn("spent", F.lit(0).cast("long"))), "edge")
    inside = ranged.join(F.broadcast(first.select("range")), "range")
    fine = F.when(F.col("range") < RANGES, F.least(F.floor((F.col("f") * (RANGES // 2) - F.col("range")) * RANGES), F.lit(RANGES - 1)).cast("int")).otherwise(0)
    inside = inside.withColumn("range", fine)
    second = edge_of(inside, first.select("spent", "budget"))
    last = inside.join(F.broadcast(second), "range")
    run = W.partitionBy("range").orderBy("f", "e", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    cut = last.withColumn("cum", F.col("spent") + F.sum("size").over(run)).where(F.col("cum") > F.col("budget")).agg(F.min(F.struct("f", "e", "doc_id", "size")).alias("cut"))

    cut = materialize(cut, "cut")
    judged = served.crossJoin(F.broadcast(cut)).withColumn("in", F.col("cut").isNull() | (F.struct("f", "e", "doc_id", "size") < F.col("cut")))  # one row
    ends = [f(F.when((F.col("e") == e) & test, place)).alias(f"{label}{e}") for e in range(epochs) for label, f, test in (("last", F.max, F.col("in")), ("next", F.min, ~F.col("in")))]
    bounds = materialize(targets.join(judged.groupBy("name").agg(*ends), "name", "left"), "bounds")

    rows = rows.join(bounds, "name")
    split = [F.coalesce(F.col(f"last{e}").eqNullSafe(F.col(f"next{e}")) & F.col(f"last{e}").isNotNull(), F.lit(False)) for e in range(epochs)]
    at = [s & place.eqNullSafe(F.col(f"last{e}")) for e, s in enumerate(split)]
    got = [F.when((F.col("size") > 0) & (F.col("target") > 0) & (place <= F.col(f"last{e}")), F.col("size")).otherwise(F.lit(0)) for e in range(epochs)]
    total = lambda parts: sum(parts[1:], parts[0]).cast("long").alias("taken")
    fixed = ["row", "doc_id", "source", "size", "source_size", "target"]
    if bounds.where(_any(split)).isEmpty():
        out = rows.select(*fixed, total(got))
    else:  # a bound inside rows that are equal in id, source and size: so many of them, counted in the queue, are in
        counts = judged.where("in").join(bounds, "name").where(_any([a & (F.col("e") == e) for e, a in enumerate(at)]))
        counts = materialize(counts.groupBy("name").agg(*[F.sum((F.col("e") == e).cast("long")).alias(f"n{e}") for e in range(epochs)]), "split")
        nth = F.row_number().over(W.partitionBy("name", "key", "doc_id", "size").orderBy("key"))
        equal = rows.where(_any(at)).withColumn("nth", nth).join(counts, "name")
        part = [F.when(a, F.when(F.col("nth") <= F.col(f"n{e}"), F.col("size")).otherwise(F.lit(0))).otherwise(g) for e, (a, g) in enumerate(zip(at, got, strict=True))]
        out = rows.where(~_any(at)).select(*fixed, total(got)).unionByName(equal.select(*fixed, total(part)))
    discard(slots, timed, targets, first, cut)
    return out


def _name(source: str) -> Column:
    """A source's name without nulls, for joins."""
    return F.concat(F.when(F.col(source).isNull(), "-").otherwise("+"), F.coalesce(F.col(source).cast("string"), F.lit("")))


def _any(tests: list[Column]) -> Column:
    return reduce(or_, tests)


def word_count(column: str = "text"):
    """Number of runs of anything but ASCII white space; null: 0."""
    return F.regexp_count(text_or_empty(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with what mix gives them; a document's row for each row of the table, no rows for an empty one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size"))
    return mix(materialize(docs, "sizes")).select("doc_id", "size", "source_size", "target", "taken")  # texts are read once


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it; columns as before, whatever their names.

    Null and empty texts have no words and are never taken; null ids and sources and repeated rows are as mix says.
    """
    sized = docs.select(F.struct("*").alias("row"), "doc_id", "source", word_count().alias("size"))
    sizes = materialize(sized.select("doc_id", "source", "size"), "sizes")
    mixed = _queue(sized, sizes=sizes)
    discard(sizes)
    times = (F.col("taken") / F.col("size")).cast("int")
    return mixed.where("taken > 0").select("row", F.explode(F.sequence(F.lit(1), times))).select("row.*")


ORACLE = r"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
                  md5('mix:' || coalesce(doc_id::varchar, 'null')) as k from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as i from d group by source),
w as (select *, case i % 3 when 0 then 3.0 when 1 then 1.0 else 2.0 end::double as w, (source_size * 2)::double as cap from s),
x as (select *, sum(source_size) over () * 1.5::double as budget,
             coalesce(sum(cap) over (order by cap / w, i rows between unbounded preceding and 1 preceding), 0) as capped,
             sum(w) over (order by cap / w, i rows between current row and unbounded following) as rest from w),
y as (select *, (budget - capped) / rest as level from x),
l as (select arg_min(level, {'a': cap / w, 'i': i}) as l from y where level * w <= cap),
t as (select source, source_size, coalesce(least(cap, l.l * w), cap) as target from y, l),
q as (select d.*, t.source_size, t.target, sum(size) over (partition by d.source order by substr(k, 1, 3), k, doc_id, size rows unbounded preceding) as c
      from d join t on d.source is not distinct from t.source),
f as (select *, (c + e * source_size) / target as f from q, (select unnest([0, 1]) as e) where size > 0 and target > 0),
o as (select *, sum(size) over (order by f, e, doc_id, size rows unbounded preceding) as cum, (select floor(sum(target) + 0.5) from t) as b from f),
g as (select doc_id, sum(case when cum <= b then size else 0 end)::bigint as taken from o group by doc_id)
select q.doc_id, q.size, q.source_size, q.target, coalesce(g.taken, 0)::bigint as taken from q left join g using (doc_id)
"""
