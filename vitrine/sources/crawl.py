"""A site of seed, region, city and store pages: levels of pages, each got and parsed once, written to the shared folder and joined downwards."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.places import sanitize_location
from ..operators.dedup import keep_first
from ..operators.enrich import with_detail
from ..shared import Watch, cut, put
from . import html as H
from .fetched import issues

PAGES_PER_CITY = 20  # the reference behaviour: a city's pagination is followed over so many pages
TOP = (*H.CITY_LINKS, "active_region")
LISTING = (*H.SUMMARIES, *H.PAGE_LINKS, *H.CITY_CONTEXT)


@dataclass
class Site:
    """stores: store-like rows with outcome (parsed, partial); skipped: urls without anything to say; issues: (scope, url, status, level);
    links: city links (rank, on: their page, pos, href, city_url, reason; null reason: accepted); outcomes: stores by outcome."""

    stores: DataFrame
    skipped: DataFrame
    issues: DataFrame
    links: DataFrame
    outcomes: Watch


def queues(starts: DataFrame, links: DataFrame, most: int) -> DataFrame:
    """S15. (start, queue): the pages that are reached from each start (start), in a queue's order, the start first, at most `most` of them.

    links: (url, links array), a row a page. A round takes all pages of a queue that weren't taken yet: their links that the queue doesn't hold are
    appended by place of page, then of link, which is the order of taking them one by one. A queue leaves the rounds when it is full or nothing was appended; each
    round of a queue that stays appends a page at least, so there are `most` rounds at the most, and some five where pages have two new links each.
    """
    spark = starts.sparkSession
    known = spark.read.schema(links.select("url", "links").schema).parquet(put(links.select("url", "links").where("url is not null and links is not null")))
    live = starts.select("start").where("start is not null").distinct().select("start", F.array("start").alias("queue"), F.lit(0).alias("taken"))
    found, rounds = F.flatten(F.transform(F.array_sort("found"), lambda x: x["links"])), []
    while True:
        pending = live.select("start", "taken", F.posexplode("queue").alias("pos", "url")).where("pos >= taken").select("start", "pos", "url")
        held = live.select("start", "queue", F.lit(None).cast(f"struct<pos int, links {known.schema['links'].dataType.simpleString()}>").alias("at"))
        here = pending.join(known, "url").select("start", F.lit(None).cast(live.schema["queue"].dataType).alias("queue"), F.struct("pos", "links").alias("at"))
        both = held.union(here).groupBy("start").agg(F.any_value("queue", True).alias("had"), F.collect_list("at").alias("found"))
        after = both.select("start", F.slice(F.array_union("had", found), 1, most).alias("queue"), F.size("had").alias("taken"))
        after = after.withColumn("live", (F.size("queue") > F.col("taken")) & (F.size("queue") < most))
        path = put(after, "live")
        rounds.append(spark.read.schema(after.schema).parquet(path))
        if rounds[-1].where("live").isEmpty():
            return reduce(DataFrame.union, [r.where("not live").select("start", "queue") for r in rounds])
        live = spark.read.schema(live.schema).parquet(f"{path}/live=true")  # its own size tells Spark when few queues are left


def crawl(spark: SparkSession, get: Callable[[DataFrame, str | None], DataFrame] | None, seed: str, site: str, *, most_pages: int = PAGES_PER_CITY, table: DataFrame | None = None) -> Site:
    """S13-S16, H1-H14, X3-X5, D7, G4, P10.

    get: urls (url) and a referer to (url, final_url, status, body), live, level by level. table: fetched pages instead; they are parsed once, and
    the cities' pagination is rounds of joins over their links. The seed or a region that
    can't be read, and a seed without regions, fail as a whole (E5).
    """
    failed: list[DataFrame] = []

    def parsed(got: DataFrame, fields: tuple[str, ...]) -> DataFrame:
        good = F.col("body").isNotNull() & (F.coalesce("status", F.lit(200)) < 400)
        fresh = got.select("url", F.coalesce("final_url", "url").alias("final_url"), F.col("status").cast("int").alias("status"), F.when(good, F.col("body")).alias("body"))
        return cut(H.parse_pages(fresh, "body", "url", fields))

    every = parsed(table, (*TOP, *LISTING, *H.STORE_PAGE)) if table is not None else None

    def pages(urls: DataFrame, scope: str, fields: tuple[str, ...], referer: str | None = None) -> DataFrame:
        wanted = urls.select("url").distinct()
        fresh = parsed(get(wanted, referer), fields) if every is None else every.join(wanted, "url", "left_semi")
        failed.append(issues(urls, fresh, scope))
        return fresh.where("body is not null").select("url", "final_url", "page")

    first = pages(spark.createDataFrame([(seed,)], "url string"), "seed page", TOP)
    regions = H.region_links(first).select(F.col("region_url").alias("url"), sanitize_location(F.col("name")).alias("name"))
    regions = cut(regions)
    n = regions.count()
    if not n:
        raise RuntimeError("the seed page is missing or has no regions")
    tops = pages(regions, "region page", TOP, seed)
    if tops.count() < n:
        raise RuntimeError("a region page is missing")
    tops = tops.join(regions, "url").select(F.col("url").alias("on"), "page", F.lit(1).alias("rank"), F.col("name").alias("region"))
    tops = tops.unionByName(first.select(F.col("url").alias("on"), "page", F.lit(0).alias("rank"), H.active_region(F.col("page")).alias("region")))
    links = H.city_links(tops, site, "rank", "on", "region")
    links = cut(links)
    accepted = links.where("reason is null").withColumn("hint", sanitize_location(F.col("hint")))
    cities = keep_first(accepted, [F.col("city_url")], [F.col("rank"), F.col("on"), F.col("pos")]).select("city_url", "hint", "region")
    cities = cut(cities)
    seen = cities.select("city_url", F.col("city_url").alias("url"), F.lit(1).cast("long").alias("n"))
    frontier, listing = seen, None
    if every is not None:
        of = H.page_links(every.where("body is not null").select(F.col("url").alias("of"), F.col("url").alias("__self"), "page"), "of")
        links_of = cut(of.groupBy(F.col("of").alias("url")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "page_url"))), lambda x: x["page_url"]).alias("links")))
        walked = queues(cities.select(F.col("city_url").alias("start")), links_of, most_pages).select(F.col("start").alias("city_url"), F.posexplode("queue").alias("n", "url"))
        walked = walked.select("city_url", "url", (F.col("n") + 1).cast("long").alias("n"))
        listing = pages(walked, "city/pagination page", LISTING).join(walked, "url").select("city_url", "url", "n", "page")
    for _ in range(most_pages if every is None else 0):
        # a queue's order: by the page that a link is on, then by its place; pages of one level come before those they link to
        level = pages(frontier, "city/pagination page", LISTING).join(frontier, "url").select("city_url", "url", "n", "page")
        listing = level if listing is None else listing.unionByName(level)
        found = H.page_links(level.withColumn("__self", F.col("url")), "city_url", "n").select("city_url", F.col("page_url").alias("url"), F.struct("n", "pos").alias("at"))
        fresh = found.groupBy("city_url", "url").agg(F.min("at").alias("at")).join(seen, ["city_url", "url"], "left_anti")
        had = seen.groupBy("city_url").agg(F.max("n").alias("had"))
        numbered = fresh.join(had, "city_url").withColumn("n", F.col("had") + F.row_number().over(W.partitionBy("city_url").orderBy("at", "url")))
        frontier = cut(numbered.where(F.col("n") <= most_pages).select("city_url", "url", F.col("n").cast("long").alias("n")))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    own = listing.where("url = city_url").select("city_url", H.city_context(F.col("page"), F.lit(None).cast("string")).alias("ctx"))
    context = cities.join(own, "city_url", "left").select("city_url", F.coalesce("hint", "ctx.city").alias("city"), F.coalesce("region", "ctx.region").alias("region"))
    stores = H.store_summaries(listing, "city_url", "n")
    stores = keep_first(stores, [F.col("store_url")], [F.col("city_url"), F.col("n"), F.col("pos")]).join(context, "city_url")
    none = F.lit(None).cast("string")
    summaries = stores.select(F.col("store_url").alias("url"), "city", "region", "address", "work_time", none.alias("phone"), none.alias("store_format"))
    summaries = cut(summaries)
    details = pages(summaries, "store page", H.STORE_PAGE).select("url", F.col("final_url").alias("moved"), *[v.alias(k) for k, v in H.store_page(F.col("page")).items()])
    outcomes = Watch()
    rows = outcomes.on(with_detail(summaries, details), **{k: F.count_if(F.col("outcome") == k) for k in ("parsed", "partial", "skipped")})
    rows = cut(rows.withColumn("source_url", F.coalesce("moved", "url")))
    stores = rows.where("outcome <> 'skipped'").select("outcome", "region", "city", "address", "work_time", "latitude", "longitude", "phone", "store_format", "status", "source_url")
    wrong = failed[0]
    for x in failed[1:]:
        wrong = wrong.unionByName(x)
    return Site(stores, rows.where("outcome = 'skipped'").select("url"), wrong, links, outcomes)
