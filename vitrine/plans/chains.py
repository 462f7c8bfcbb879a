"""The three chains as sources: from a table of fetched responses (url, status, final_url, body, error) to store-like rows.

Without a table pages are fetched by the workers. A source's rows carry what else is to know of them: `held`, caches to release once
the rows are used, `rejected`, a table (url, reason) of what could not be read, and `counts`, figures taken while the rows are made.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import canonical, stable_key
from ..operators.dedup import keep_best_map, keep_first, location_keys
from ..operators.report import first_strategy, samples
from ..shared import Watch
from ..sources import crawl, fetched, html, jsonsource, mapscript
from .config import NETWORKS, Config

log = logging.getLogger("vitrine")


def _responses(table: DataFrame | None, urls: DataFrame, cfg: Config, headers: dict[str, str] | None = None, **session) -> DataFrame:
    if table is not None:
        return table.join(urls, "url", "left_semi")
    return fetched.fetch(urls, landing=cfg.landing, timeout=cfg.timeout, retries=cfg.retries, pace=cfg.pace, headers=headers, **session)


def _source(rows: DataFrame, held: list[DataFrame], rejected: DataFrame | None = None, counts: Callable[[], dict[str, int]] = dict) -> DataFrame:
    rows.held, rows.rejected, rows.counts = held, rejected, counts
    return rows


def _watched(rows: DataFrame, keys: list, order: list) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """G3. The first row of each key, and the rows before and after, known once the rows are made."""
    before, after = Watch(), Watch()
    once = after.on(keep_first(before.on(rows, n=F.count("*")), keys, order), n=F.count("*"))
    return once, lambda: {"rows": (before.get() or {"n": 0})["n"], "kept": (after.get() or {"n": 0})["n"]}


def kb(spark: SparkSession, cfg: Config, table: DataFrame | None) -> DataFrame:
    """J16, S5, S6, D2, P8, E4. Cities, then their shops; what can't be read is set aside."""
    ends = [f"{cfg.kb_url}/api/cities/list/", f"{cfg.kb_url}/api/cities/list"]
    listed = spark.createDataFrame([(i, u) for i, u in enumerate(dict.fromkeys(ends))], "rank int, url string")
    bodies = _responses(table, listed.select("url"), cfg).join(listed, "url").select("rank", "body").persist()
    cities = jsonsource.cities(bodies).persist()
    asked = cities.select("city_id", F.format_string(f"{cfg.kb_url}/api/cities/%d/shops/", "city_id").alias("url"))
    answers = _responses(table, asked.select("url"), cfg).select("url", "body").persist()
    shops = jsonsource.shops(answers.join(asked, "url").select("city_id", "body"))
    rows = canonical(jsonsource.shop_rows(shops, cities, network=NETWORKS["kb"], base_url=cfg.kb_url), keep=("city_pos", "pos"))
    once, counts = _watched(rows, location_keys(url_fallback=True), [F.col("city_pos"), F.col("pos")])
    lost = jsonsource.nameless_cities(bodies).unionByName(fetched.rejected(asked, answers))
    return _source(once, [bodies, cities, answers], lost, counts)


def maria_ra(spark: SparkSession, cfg: Config, table: DataFrame | None) -> DataFrame:
    """M27, S7-S10, D4, D5. Inline scripts, then external ones, then data attributes: the first that yields candidates. A browser isn't driven."""
    wanted = spark.createDataFrame([(cfg.maria_ra_map_url,)], "url string")
    page = _responses(table, wanted, cfg).where(F.col("body").isNotNull()).persist()
    held, session = [page], {}
    if not page.where(mapscript.is_age_gate(F.col("body"))).isEmpty():
        log.warning("maria_ra: the map page asks for an age%s", "" if table is not None else ", trying again with its cookies")
        if table is None:  # S7: the site's first page comes first, so that its own cookies join those of age
            session = {"cookies": fetched.AGE_COOKIES, "prime": cfg.maria_ra_url}
            page = _responses(None, wanted, cfg, **session).where(F.col("body").isNotNull()).persist()
            held.append(page)
    parsed = html.parse_pages(page, "body", "url", ("scripts", "script_urls", "data")).persist()
    inline = parsed.select(F.posexplode("page.scripts").alias("pos", "script"))
    outside = parsed.select(F.posexplode("page.script_urls").alias("pos", "url"))
    loaded = _responses(table, outside.select("url").distinct(), cfg, **session).where("body is not null").join(outside, "url").select("pos", F.col("body").alias("script"))
    data = parsed.select(F.posexplode("page.data").alias("pos", "script"))
    found = None
    for rank, (texts, attribute) in enumerate(((inline, False), (loaded, False), (data, True))):
        c = mapscript.candidates(texts, attribute=attribute).drop("script")
        c = first_strategy(c.withColumn("one", F.lit(1)), "pos", ["one"]).withColumn("rank", F.lit(rank))
        found = c if found is None else found.unionByName(c)
    best = mapscript.dedup_candidates(first_strategy(found, "rank", ["one"]), ["item"])
    rows = mapscript.store_rows(best, network=NETWORKS["maria_ra"], map_url=cfg.maria_ra_map_url, keep=("item",))
    rows = stable_key(canonical(rows, keep=("item",)))
    twice = Watch()
    kept = keep_best_map(rows, F.col("item"), twice).drop("stable_key", "item")
    return _source(kept, [*held, parsed], counts=lambda: twice.get() or {"removed": 0, "conflicts": 0})


def monetka(spark: SparkSession, cfg: Config, table: DataFrame | None) -> DataFrame:
    """S13-S16, D3, G3-G5. The crawl, over fetched pages or live, level by level."""
    seed = f"{cfg.monetka_url}/shops_map/"

    def get(urls: DataFrame, referer: str | None) -> DataFrame:
        return _responses(table, urls, cfg, {"Referer": referer} if referer else None)

    site = crawl.crawl(spark, get, seed, urlparse(cfg.monetka_url).netloc, table=table)
    for r in samples(site.links).collect():  # one row a reason, ten samples each
        log.info("monetka: %s city links %s, such as %s", r.n, r.reason or "accepted", "; ".join(r.samples))
    for r in site.issues.groupBy("scope", "status", "level").agg(F.count("*").alias("n"), F.min("url").alias("url")).collect():  # one row a kind
        log.log(getattr(logging, r.level), "monetka: %s %s unavailable status_code=%s, such as %s", r.n, r.scope, r.status, r.url)
    rows = canonical(site.stores).withColumn("network", F.lit(NETWORKS["monetka"]))
    once, counts = _watched(rows, location_keys(url_fallback=False), [F.col("source_url")])
    lost = site.issues.select("url", F.concat_ws(" ", "scope", F.col("status").cast("string")).alias("reason"))
    return _source(once, [], lost, lambda: (site.outcomes.get() or {}) | counts())


def all_sources(cfg: Config, table: DataFrame | None = None):
    return {name: (lambda s, f=f: f(s, cfg, table)) for name, f in (("kb", kb), ("monetka", monetka), ("maria_ra", maria_ra))}
