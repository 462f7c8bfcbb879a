"""Operator 11, sessions of clicks by gaps, final clicks and length, found on summaries of time cells.

Cells are as wide as the gap, so a cell holds none inside, and whether one lies before it shows in the greatest time of the client's
cell before and the cell's least time. Clicks are aggregated to (client, cell) with minimum and maximum; islands without gaps are found on
these summaries and joined back to the clicks, where final clicks split them further into runs. What a run has beyond the greatest length
is split last: the first click over the length after a session's first click begins the next, a chain of jumps from click to click. All
such jumps are followed at once by doubling: after k rounds a table of jumps spans 2 ** k of them, so rounds grow with the logarithm
of the longest chain.

Scale: no task holds a client. Clicks are dealt by (client, cell) or (run, stretch of the greatest length), so a client with a third of all
rows is spread over its cells. What meets by client alone is the summaries, one row a cell: at most 35,040 a year for gaps of 15 minutes,
however many clicks. Nothing is broadcast and nothing but one bit a round goes to the driver. A session's own click ids come together in one
row, as the digest of its path demands; a session is no longer than its greatest length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from .common import discard, materialize, table

MINUTE = 60_000_000
GAP, LENGTH, LATE = 15 * MINUTE, 60 * MINUTE, 15 * MINUTE
#: A click of these kinds is final from this value on.
FINAL_KINDS, FINAL_VALUE = ("purchase", "signup"), 60


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 UTC of a time column; one without a zone is read as UTC whatever the session's zone."""
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.unix_micros(c)
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = (days * 24 + F.hour(c)) * 3600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def cents(value: Column) -> Column:
    """floor(100 * value + 0.5); null, NaN and infinite values count 0."""
    v = value.cast("double")
    plain = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return F.when(plain, F.floor(v * 100 + 0.5).cast("long")).otherwise(F.lit(0).cast("long"))


def timely_and_late(clicks: DataFrame, *, late: int = LATE) -> DataFrame:
    """(click_id, client_id, us, late, final, cents) of each click once. Rows with a null click_id, client_id or ts take no part.

    Of rows that share a click_id but differ, the one that is least in (ts, client_id, late, final, cents) counts. A click whose
    arrival is null is timely.
    """
    final = F.coalesce((F.col("value") >= FINAL_VALUE) & F.col("kind").isin(*FINAL_KINDS) & ~F.isnan("value"), F.lit(False))
    us = micros(clicks, "ts")
    rows = clicks.where("click_id is not null and client_id is not null and ts is not null").select(
        F.col("click_id").cast("long"), F.col("client_id").cast("long"), us.alias("us"), F.coalesce(micros(clicks, "arrived_at") - us > late, F.lit(False)).alias("late"), final.alias("final"), cents(F.col("value")).alias("cents"))
    once = W.partitionBy("click_id").orderBy("us", "client_id", "late", "final", "cents")
    return rows.withColumn("n", F.lag("click_id").over(once)).where("n is null").drop("n")


def runs(clicks: DataFrame, *, gap: int = GAP) -> DataFrame:
    """The rows of timely_and_late in runs: plus run (click_id of its first click), run_us (that one's time), at_us and ends.

    A run is what neither a gap nor a final click splits. ends, on a run's last click only: end, gap or none (no click follows). A late click
    goes with the timely click that it follows, at the same time or later: at_us is that one's time, its own for timely clicks. Late
    clicks before all timely ones of their client belong to none and are left out.
    """
    cell = F.floor(F.col("us") / gap).cast("long")
    # dealt once by (client, cell), which serves the summary and the way back alike; for that both must need the same columns, so cents is in the order
    dealt = clicks.withColumn("cell", cell).repartition("client_id", "cell")
    inside = W.partitionBy("client_id", "cell", "late").orderBy("us", "click_id", "cents")
    dealt = dealt.withColumns({"before": F.lag("final").over(inside), "after_us": F.lead("us").over(inside)})
    timely, first, last = ~F.col("late"), F.col("before").isNull(), F.col("after_us").isNull()
    begins = timely & F.coalesce("before", F.lit(False))  # a final click right before, in the same cell
    summary = dealt.groupBy("client_id", "cell").agg(
        F.min(F.when(timely, F.col("us"))).alias("lo"), F.max(F.when(timely, F.col("us"))).alias("hi"),
        F.max(F.when(timely & first, F.col("click_id"))).alias("first_id"), F.max(F.when(timely & last, F.col("final"))).alias("last_final"),
        F.max(F.when(begins, F.struct("us", "click_id"))).alias("inner"))
    # islands on the summaries: a row a cell
    line = W.partitionBy("client_id").orderBy("cell")
    earlier = line.rowsBetween(W.unboundedPreceding, -1)
    cells = summary.withColumns({"prior_us": F.last("hi", True).over(earlier), "prior_final": F.last("last_final", True).over(earlier)})
    opens = F.col("lo").isNotNull() & (F.col("prior_us").isNull() | F.col("prior_final") | (F.col("lo") - F.col("prior_us") >= gap))
    opening = F.when(opens, F.struct(F.col("lo").alias("us"), F.col("first_id").alias("click_id")))
    cells = cells.withColumns({"opening": opening, "start": F.coalesce("inner", opening)})
    later = W.partitionBy("client_id").orderBy(F.col("cell").desc()).rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumns({"carried": F.last("start", True).over(earlier), "next_us": F.last("lo", True).over(later)})
    cells = cells.select("client_id", "cell", "opening", "carried", "prior_us", "next_us")
    # back to the clicks
    met = dealt.join(cells, ["client_id", "cell"])
    own = F.when(timely, F.when(first, F.col("opening")).when(F.col("before"), F.struct("us", "click_id")))
    order = W.partitionBy("client_id", "cell").orderBy("us", "late", "click_id").rowsBetween(W.unboundedPreceding, 0)
    met = met.withColumn("own", own).withColumns({
        "begin": F.coalesce(F.last("own", True).over(order), F.col("carried")),
        "at_us": F.coalesce(F.last(F.when(timely, F.col("us")), True).over(order), F.col("prior_us"))})
    following = F.coalesce("after_us", "next_us")
    ends = F.when(timely, F.when(F.col("final"), "end").when(following.isNull(), "none").when(following - F.col("us") >= gap, "gap"))
    return met.where("begin is not null").select("click_id", "client_id", "us", "late", "cents", F.col("begin.click_id").alias("run"), F.col("begin.us").alias("run_us"), "at_us", ends.alias("ends"))


def _stretch(t: Column, length: int) -> Column:
    """Which stretch of a run a time is in: 0 up to the length after the run's first click, inclusive, then 1 and so on."""
    return F.floor((t - F.col("run_us") - 1) / length).cast("long")


def chain(over: DataFrame, *, length: int = LENGTH, max_rounds: int = 60) -> DataFrame:
    """(run, run_us, us): the times at which the runs' second and later sessions begin, from rows (run, run_us, us) over the length after run_us.

    A stretch holds at most one such time. Each time's jump goes to the first time of its run over the length later, found in the stretch
    that starts there or in the one after, as no gap in a run is as wide as a stretch.
    """
    times = over.select("run", "run_us", "us").distinct()
    row = lambda t, stretch, asks: F.struct(stretch.cast("long").alias("stretch"), t.alias("t"), F.lit(asks).alias("asks"))
    us, s = F.col("us"), _stretch(F.col("us"), length)
    spread = times.select("run", "run_us", F.inline(F.array(row(us, s, False), row(us, s - 1, False), row(us + length, s + 1, True))))
    # latest first; at one time the question comes before the answer, which must be later than it
    back = W.partitionBy("run", "stretch").orderBy(F.col("t").desc(), F.col("asks").desc()).rowsBetween(W.unboundedPreceding, -1)
    jumps = spread.withColumn("to", F.last(F.when(~F.col("asks"), F.col("t")), True).over(back)).where("asks and to is not null").select("run", (F.col("t") - length).alias("us"), "to")
    jumps = materialize(jumps, "jumps")
    starts = materialize(times.groupBy("run", "run_us").agg(F.min("us").alias("us")), "starts")
    used = [jumps, starts]
    for _ in range(max_rounds):
        if jumps.isEmpty():
            discard(*[x for x in used if x is not starts])
            return starts
        reached = starts.join(jumps, ["run", "us"]).select("run", "run_us", F.col("to").alias("us"))
        starts = materialize(starts.unionByName(reached), "starts")
        jumps = materialize(jumps.join(jumps.select("run", F.col("us").alias("to"), F.col("to").alias("next")), ["run", "to"]).select("run", "us", F.col("next").alias("to")), "jumps")
        used += [jumps, starts]
    raise RuntimeError(f"more than 2 ** {max_rounds} sessions in a run")


def sessions(clicks: DataFrame, *, gap: int = GAP, length: int = LENGTH, late: int = LATE) -> DataFrame:
    """Sessions of clicks (click_id, ts, arrived_at, client_id, kind, value), as the contract of op11 has them; all times in microseconds.

    Repeated rows count once; rows with a null click_id, client_id or ts take no part, null kinds and values are not final and
    count 0. An empty table gives no sessions. More columns are ignored, whatever their names. A gap wider than the length is refused.
    """
    if not 0 < gap <= length:
        raise ValueError("gap must be above 0 and at most length")
    rows = materialize(runs(timely_and_late(clicks, late=late), gap=gap), "runs")
    within = F.col("at_us") <= F.col("run_us") + length
    over = rows.where(~within)
    starts = chain(over.where(~F.col("late")), length=length)
    # the last start at or before a click is in its stretch or the one before
    mark = lambda k: starts.select("run", "run_us", (_stretch(F.col("us"), length) + k).alias("stretch"), F.col("us").alias("at_us"), F.col("us").alias("begin"))
    marked = over.withColumn("stretch", _stretch(F.col("at_us"), length)).unionByName(mark(0), allowMissingColumns=True).unionByName(mark(1), allowMissingColumns=True)
    so_far = W.partitionBy("run", "stretch").orderBy("at_us", F.col("begin").isNull()).rowsBetween(W.unboundedPreceding, 0)
    split = marked.withColumn("begin", F.last("begin", True).over(so_far)).where("click_id is not null").drop("stretch")
    placed = rows.where(within).withColumn("begin", F.col("run_us")).unionByName(split)
    on_time = ~F.col("late")
    path = F.sort_array(F.collect_list(F.when(on_time, F.struct("us", "click_id"))))
    out = placed.groupBy("client_id", "run", "begin").agg(
        path.alias("path"), F.min(F.when(on_time, F.col("us"))).alias("start_us"), F.max(F.when(on_time, F.col("us"))).alias("end_us"),
        F.count(F.when(on_time, 1)).alias("n_clicks"), F.count(F.when(F.col("late"), 1)).alias("n_late"),
        F.sum(F.when(on_time, F.col("cents")).otherwise(0)).alias("value_cents"), F.coalesce(F.max("ends"), F.lit("length")).alias("closed_by"))
    ids = F.transform("path", lambda x: x["click_id"].cast("string"))
    return out.select("client_id", F.col("path")[0]["click_id"].alias("session_id"), "start_us", "end_us", "n_clicks", "n_late", "value_cents", "closed_by", F.sha2(F.array_join(ids, ","), 256).alias("path_sha256"))


def op11_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of all clicks: gap 15 minutes, length 60, late after 15. Nulls, repeats and empty tables as sessions() has them."""
    return sessions(table(spark, sf_dir, "clicks"))


ORACLE = """
with recursive once as (select distinct on (click_id) click_id, client_id, epoch_us(ts) as us, epoch_us(arrived_at) - epoch_us(ts) > 900000000 as late,
    coalesce(value >= 60 and kind in ('purchase', 'signup'), false) as final, coalesce(floor(100 * value + 0.5), 0)::bigint as cents
    from clicks where click_id is not null and client_id is not null and ts is not null order by click_id, us),
timely as (select *, lag(us) over w as before_us, lag(final) over w as before_final, lead(us) over w as after_us from once where late is not true window w as (partition by client_id order by us, click_id)),
marked as (select *, sum(case when before_us is null or before_final or us - before_us >= 900000000 then 1 else 0 end) over (partition by client_id order by us, click_id) as run from timely),
starts(client_id, run, us) as (select client_id, run, min(us) from marked group by 1, 2
    union all select s.client_id, s.run, min(m.us) from starts s join marked m on m.client_id = s.client_id and m.run = s.run and m.us > s.us + 3600000000 group by s.client_id, s.run, s.us),
placed as (select m.*, s.us as begin_us from marked m asof join starts s on m.client_id = s.client_id and m.run = s.run and m.us >= s.us),
made as (select client_id, arg_min(click_id, (us, click_id)) as session_id, min(us) as start_us, max(us) as end_us, count(*) as n_clicks, sum(cents)::bigint as value_cents,
    arg_max(case when final then 'end' when after_us is null then 'none' when after_us - us >= 900000000 then 'gap' else 'length' end, (us, click_id)) as closed_by,
    sha256(string_agg(click_id::varchar, ',' order by us, click_id)) as path_sha256, run from placed group by client_id, run, begin_us),
ranges as (select *, lead(start_us) over (partition by client_id order by run, start_us) as next_us from made),
lates as (select r.session_id, count(*) as n_late from ranges r join once o on o.late and o.client_id = r.client_id and o.us >= r.start_us and (r.next_us is null or o.us < r.next_us) group by 1)
select client_id, session_id, start_us, end_us, n_clicks, coalesce(n_late, 0) as n_late, value_cents, closed_by, path_sha256 from ranges left join lates using (session_id)
"""
