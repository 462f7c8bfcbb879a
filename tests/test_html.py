"""Fields of a page as they are asked for."""

import pytest
from pyspark.sql import functions as F

from vitrine.sources import html

PAGE = """<title>T</title><h1>Карта магазинов в Омске</h1><span class="x black dashed">Край</span><script src="/a.js">var a = 1;</script><div data-shops="[1]">x</div>
<div id="city_layer"><li class="act"><span>Регион</span><a>Ссылка</a></li></div><ul class="shop_city_list_ul"><li><a href=" /u/shops_map/one#f ">Город</a></ul>
<div><p><a href="/shops_map/e/5">ул Мира, 5</a></p>8-22</div><a name="none">no</a><a href="http://[bad">bad</a>
<dl><dt>Адрес<dd>ул Мира<dt>Без пары</dl><div class="wide contacts"><dt>Режим</dt><dd>9-21</dd><dl><dt>Город</dt><dd>Омск</dd></dl></div>
<i data-lat="1.5" data-lon="2.5"></i><i data-lat="3"></i><meta itemprop="latitude" content="4"><meta itemprop="longitude" content="5">"""


def rows(spark, pages, *fields):
    df = html.parse_pages(spark.createDataFrame(pages, "id int, html string, url string"), fields=fields) if fields else html.parse_pages(spark.createDataFrame(pages, "id int, html string, url string"))
    return {r.id: r.page.asDict(recursive=True) for r in df.collect()}


def test_whole_page(spark):
    got = rows(spark, [(1, PAGE, "https://s.ru/c")])[1]
    assert list(got) == list(html.FIELDS)
    assert (got["title"], got["h1"], got["region_hint"], got["active_region"]) == ("T", "Карта магазинов в Омске", "Край", ["Регион", "Ссылка"])
    assert (got["scripts"], got["script_urls"], got["data"]) == (["var a = 1;"], ["https://s.ru/a.js"], ["[1]"])
    assert got["anchors"] == [
        {"href": "/u/shops_map/one#f", "url": "https://s.ru/u/shops_map/one#f", "text": "Город", "in_city_list": True, "around": []},
        {"href": "/shops_map/e/5", "url": "https://s.ru/shops_map/e/5", "text": "ул Мира, 5", "in_city_list": False, "around": ["ул Мира, 5", "8-22"]},
        {"href": "http://[bad", "url": "http://[bad", "text": "bad", "in_city_list": False, "around": []},
    ]
    assert [(p["block"], p["pos"], p["label"], p["value"]) for p in got["pairs"]] == [(0, 0, "Адрес", "ул Мира"), (1, 0, "Режим", "9-21"), (1, 1, "Город", "Омск"), (2, 0, "Город", "Омск")]
    assert got["geo"] == [{"lat": "1.5", "lng": "2.5"}, {"lat": "4", "lng": "5"}]


def test_each_field_alone_is_that_of_the_whole(spark):
    """Each field, and each part of records, asked for alone: nothing else is in the plan, and the values are the same."""
    pages = [(1, PAGE, "https://s.ru/c"), (2, "", None), (3, None, "https://s.ru"), (4, "plain < text", "x"), (5, PAGE, None)]
    whole = rows(spark, pages)
    for name, kind in html.FIELDS.items():
        for part in (None, *kind) if isinstance(kind, dict) else (None,):
            alone = rows(spark, pages, name if part is None else f"{name}.{part}")
            want = {i: {name: p[name] if part is None else [{part: x[part]} for x in p[name]]} for i, p in whole.items()}
            assert alone == want, (name, part)
    empty = {n: None if kind == "string" else [] for n, kind in html.FIELDS.items()}
    assert whole[2] == whole[3] == empty
    assert html.parse_pages(spark.createDataFrame([], "html string, url string"), fields=["h1"]).collect() == []


def test_what_is_no_url_stays_as_it_is(spark):
    """A script or a page whose url can't be parsed doesn't end the job."""
    got = rows(spark, [(1, '<script src="http://[x"></script><script src="/a.js"></script>', "https://s.ru/c"), (2, PAGE, "http://[b")], "script_urls", "anchors.url")
    assert got[1]["script_urls"] == ["http://[x", "https://s.ru/a.js"] and got[2]["script_urls"] == ["/a.js"]
    assert [a["url"] for a in got[2]["anchors"]] == ["/u/shops_map/one#f", "/shops_map/e/5", "http://[bad"]


def test_references_count_only_whole(spark):
    """A reference that is cut off stays, in texts, attributes and scripts; numbers and whole names are resolved."""
    page = '<h1>a&amp;b &amp &lt;c&#x27;&#39 &ampx; &quo R&D; &copy</h1><a href="/x?a=1&copy=2&amp;b=3&lt">l</a><script>if (a&&b &amp c) {}</script>'
    got = rows(spark, [(1, page, "https://s.ru/c"), (2, page.replace("a=1", "a=\ufdd0"), None)], "h1", "anchors.href", "scripts")
    assert got[1]["h1"] == got[2]["h1"] == "a&b &amp <c'' &ampx; &quo R&D; &copy"
    assert (got[1]["anchors"], got[1]["scripts"]) == ([{"href": "/x?a=1&copy=2&b=3&lt"}], ["if (a&&b &amp c) {}"])
    assert got[2]["anchors"] == [{"href": "/x?a=\ufdd0&copy=2&b=3&lt"}]


def test_headings_of_odd_pages(spark, tmp_path):
    """page_headings: cut references, a page without a heading and a null page, as its SQL has them."""
    import duckdb

    from vitrine.plans import catalog

    pages = [(1, "<h1> x&amp;&amp</h1><a href=\"/a\">b</a>"), (2, "<p>none</p>"), (3, None)]
    spark.createDataFrame(pages, "page_id long, html string").withColumn("url", F.lit("https://s.ru/")).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(tuple(r) for r in catalog.page_headings(spark, str(tmp_path)).collect()) == sorted(con.execute(catalog.oracle_sql()["page_headings"]).fetchall())


def test_plan_keeps_what_was_asked():
    assert html.planned(["geo", "anchors.url", "h1", "anchors.href"]) == {"h1": (), "anchors": ("href", "url"), "geo": ("lat", "lng")}
    for bad in (["h2"], ["anchors.h1"], []):
        with pytest.raises(ValueError):
            html.planned(bad)


def test_what_functions_need_is_declared(spark):
    """Each reader of a page works on the fields that are declared for it."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, PAGE, "https://s.ru/c")], "id int, html string, url string")
    parsed = lambda fields: html.parse_pages(df, fields=fields)
    assert html.region_links(parsed(html.REGION_LINKS), "id").count() == 0
    assert [r.hint for r in html.city_links(parsed(html.CITY_LINKS), "s.ru", "id").collect()] == ["Город"]
    assert [(r.address, r.work_time) for r in html.store_summaries(parsed(html.SUMMARIES), "id").collect()] == [("ул. Мира, 5", "08:00-22:00")]
    assert html.page_links(parsed(html.PAGE_LINKS).withColumn("__self", F.col("url")), "id").count() == 0
    assert parsed(html.CITY_CONTEXT).select(html.city_context(F.col("page"), F.lit(None).cast("string")).alias("c")).first().c == ("Омске", "Край")
    r = parsed(html.STORE_PAGE).select(*[v.alias(k) for k, v in html.store_page(F.col("page")).items()]).first()
    assert (r.city, r.work_time, r.latitude) == ("Омск", "09:00-21:00", 1.5)
