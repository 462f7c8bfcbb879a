"""The three chains over tables of fetched responses, the snapshot store and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from vitrine.operators.diff import diff
from vitrine.plans import chains, config, runner
from vitrine.sources import fetched
from vitrine.sources import snapshot as S

RESPONSES = "url string, status int, final_url string, body string, error string"
SITE = "https://www.monetka.ru"


def responses(spark, pages):
    rows = [(u, x, None, None, "HTTP") if isinstance(x, int) else (u, 200, x[0], x[1], None) if isinstance(x, tuple) else (u, 200, u, x, None) for u, x in pages.items()]
    return spark.createDataFrame(rows, RESPONSES)


def collect(df, *columns):
    out = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    for x in getattr(df, "held", ()):
        x.unpersist()
    return out


CITY = '<div class="shopstore"><a href="{}">{}</a><div>{}</div></div>'


def site(**more):
    pages = {
        f"{SITE}/shops_map/": '<div id="city_layer"><ul><li class="act"><span>Seed Region</span></li></ul></div><ul class="shop_city_list_ul"><li><a href="/u/shops_map/Seedtown">Seedtown</a></ul><a href="/reg-b/change">Region B</a><a href="/reg-a/change">Region A</a>',
        f"{SITE}/reg-a/change": '<a href="/u/shops_map/out">Outside</a><ul class="shop_city_list_ul"><li><a href="/u/shops_map/one">City One</a><li><a href="/u/shops_map/Seedtown">Again</a><li><a href="/u/shops_map/+bad">Bad</a></ul>',
        f"{SITE}/reg-b/change": '<ul class="shop_city_list_ul"><li><a href="/u/shops_map/two">City Two</a><li><a href="/u/shops_map/one">Other name</a></ul>',
        f"{SITE}/u/shops_map/Seedtown": "<html></html>",
        f"{SITE}/u/shops_map/one": CITY.format("/shops_map/e/1", "ул Зелёная, 35А", "8:00-21:00") + '<a href="?PAGEN_1=2">2</a>',
        f"{SITE}/u/shops_map/one?PAGEN_1=2": CITY.format("/shops_map/e/2", "пер Лесной, 1", "круглосуточно") + CITY.format("/shops_map/e/1", "другая", "1-2") + '<span class="black dashed">Wrong</span>',
        f"{SITE}/u/shops_map/two": CITY.format("/shops_map/e/3", "ул Мира, 3", "нет"),
        f"{SITE}/shops_map/e/1": (f"{SITE}/shops_map/e/1001", "<dl><dt>Телефон</dt><dd>8 800</dd><dt>Режим</dt><dd>9-22</dd></dl><footer>тел: 1</footer>"),
        f"{SITE}/shops_map/e/2": 404,
        f"{SITE}/shops_map/e/3": '<h1>Карта магазинов в Перми</h1><dl><dt>Город</dt><dd>Асбест</dd></dl><meta property="place:location:latitude" content="55,5"><meta property="place:location:longitude" content="60.5">',
    }
    return pages | more


def test_crawl(spark):
    cfg = config.from_env()
    df = chains.monetka(spark, cfg, responses(spark, site()))
    lost = {(r.url, r.reason) for r in df.rejected.collect()}
    assert lost == {(f"{SITE}/shops_map/e/2", "store page 404")}
    got = collect(df, "region", "city", "address", "work_time", "phone", "latitude", "source_url")
    assert got == [
        ("Region A", "City One", "пер. Лесной, 1", "круглосуточно", None, None, f"{SITE}/shops_map/e/2"),
        ("Region A", "City One", "ул. Зелёная, 35А", "09:00-22:00", "8 800", None, f"{SITE}/shops_map/e/1001"),
        (None, "Асбест", "ул. Мира, 3", None, None, 55.5, f"{SITE}/shops_map/e/3"),
    ]
    assert df.counts() == {"parsed": 2, "partial": 1, "skipped": 0, "rows": 3, "kept": 3}


def test_crawl_city_failure_and_frontier(spark):
    cfg = config.from_env()
    df = chains.monetka(spark, cfg, responses(spark, site(**{f"{SITE}/u/shops_map/one": 404})))
    levels = {(r.url, r.reason) for r in df.rejected.collect()}
    assert (f"{SITE}/u/shops_map/one", "city/pagination page 404") in levels
    assert [r[0] for r in collect(df, "city")] == ["Асбест"]
    for broken in ({f"{SITE}/reg-a/change": 500}, {f"{SITE}/shops_map/": "<ul class='shop_city_list_ul'><li><a href='/u/shops_map/x'>x</a></ul>"}, {f"{SITE}/shops_map/": 503}):
        with pytest.raises(RuntimeError):
            chains.monetka(spark, cfg, responses(spark, site(**broken)))


@pytest.mark.parametrize("way", ["levels", "recursive"])
def test_crawl_queue_order_and_cap(spark, way):
    """25 pages that link on: 20 are visited, in the queue's order, failed ones too; the first place of a store counts."""
    from vitrine.sources import crawl

    one = f"{SITE}/u/shops_map/one"
    page = lambda n: f"{one}?page={n}"
    pages = {f"{SITE}/shops_map/": '<a href="/reg-a/change">A</a>', f"{SITE}/reg-a/change": '<ul class="shop_city_list_ul"><li><a href="/u/shops_map/one">One</a></ul>'}
    pages[one] = "".join(f'<a href="?page={n}">{n}</a>' for n in range(12, 2, -1))
    for n in range(3, 40):
        pages[page(n)] = f'<a href="/shops_map/e/{n}">ул {n}</a><a href="/shops_map/e/99">ул {n}</a><a href="?page={n + 10}">next</a>'
    pages[page(12)] = 500
    table = responses(spark, pages)
    get = {"get": lambda urls, _: table.join(urls, "url", "left_semi")} if way == "levels" else {"get": None, "table": table}
    got = crawl.crawl(spark, seed=f"{SITE}/shops_map/", site="www.monetka.ru", **get)
    assert [(r.url, r.status) for r in got.issues.where("status = 500").collect()] == [(page(12), 500)]
    stores = {r.source_url.rsplit("/", 1)[1]: r.address for r in got.stores.collect()}
    # 1 city page, ten of the first level (12 fails), then nine of the second: 21 down to 13
    assert set(stores) == {str(n) for n in [*range(3, 12), *range(13, 22)]} | {"99"} and stores["99"] == "ул. 11"


def test_kb(spark):
    cfg = config.from_env()
    base = cfg.kb_url
    pages = {
        f"{base}/api/cities/list/": "not json",
        f"{base}/api/cities/list": json.dumps({"result": {"cities": [{"id": "7", "name": "Омск", "regionId": 2}, {"id": 8, "title": "x", "name": "Томск"}, {"name": "Нет"}]}, "regions": [{"id": 2, "name": "Омская область"}]}),
        f"{base}/api/cities/7/shops/": json.dumps({"items": [{"id": 1, "address": "ул. Мира, 1", "workTime": {"daily": "9-21"}, "phones": [" ", "8"], "isActive": True, "lat": "x", "latitude": 55.5, "lng": 60}, {"id": 2, "fullAddress": "УЛ. мира, 1"}, 3, {"shopId": 5, "address": None}]}),
        f"{base}/api/cities/8/shops/": "<html>",
    }
    df = chains.kb(spark, cfg, responses(spark, pages))
    assert {(r.url, r.reason) for r in df.rejected.collect()} == {("city Нет", "no id"), (f"{base}/api/cities/8/shops/", "invalid json")}
    assert collect(df, "region", "city", "address", "work_time", "phone", "status", "latitude", "longitude", "source_url") == [
        ("Омская область", "Омск", "ул. Мира, 1", "9-21", "8", "active", 55.5, 60.0, f"{base}/api/cities/7/shops/#1"),
        ("Омская область", "Омск", None, None, None, None, None, None, f"{base}/api/cities/7/shops/#5"),
    ]
    assert df.counts() == {"rows": 3, "kept": 2}


@pytest.mark.parametrize("where", ["inline", "outside", "data"])
def test_maria_ra(spark, where):
    """The first strategy that yields anything; a page that still asks for an age is read all the same."""
    cfg = config.from_env()
    items = [{"address": "Алтайский край, г. Барнаул, ул Попова, 1", "lat": "53,3", "lng": "83.7"}, {"address": "Алтайский край, г. Барнаул, ул Попова, 1", "lat": "53,3", "lng": "83.7"}, {"city": "г. Бийск", "address": "ул Мира, 5", "work_time": "8-22"}]
    script = f"var shops = {json.dumps(items, ensure_ascii=False)};"
    body = {"inline": f"<p>age-gate</p><script>x</script><script>{script}</script>", "outside": '<script src="/a.js"></script><script src="/b.js"></script>', "data": "<div data-shops='" + json.dumps(items, ensure_ascii=False) + "'></div>"}[where]
    df = chains.maria_ra(spark, cfg, responses(spark, {cfg.maria_ra_map_url: body, f"{cfg.maria_ra_url}/b.js": script, f"{cfg.maria_ra_url}/a.js": 404}))
    assert cfg.maria_ra_map_url == "https://www.maria-ra.ru/o-kompanii/karta-seti/"
    assert collect(df, "region", "city", "address", "work_time", "latitude", "source_url") == [
        ("Алтайский край", "Барнаул", "ул. Попова, 1", None, 53.3, f"{cfg.maria_ra_map_url}#store=53.300000,83.700000"),
        (None, "Бийск", "ул. Мира, 5", "8-22", None, f"{cfg.maria_ra_map_url}#store=улмира5"),
    ]
    assert df.counts() == {"removed": 0, "conflicts": 0}  # D4 took the copy before keys were


ROW = "network string, source_url string, work_time string"


def stores(spark, *hours):
    return spark.createDataFrame([("N", f"https://x.ru/shop/{i}", h) for i, h in enumerate(hours)], ROW)


def test_snapshot_document(spark, tmp_path):
    """A JSON document with older names; the first name that is there counts. Other shapes are invalid."""
    p = tmp_path / "s.json"
    p.write_text(json.dumps({"stores": [{"network": "N", "lat": "1.5", "lng": None, "lon": 3, "source_url": "u", "parsed_at": "t", "stable_key": "stale"}, 5]}))
    got = S.load(spark, str(p))
    row = got.rows.first()
    assert (got.status, row.latitude, row.longitude, row.collected_at) == ("loaded", 1.5, None, "t") and len(row.stable_key) == 40
    for bad in ("[1]", "{", '{"stores": {}}'):
        p.write_text(bad)
        assert S.load(spark, str(p)).status == "invalid"


def test_set_aside_and_empty_source(spark, tmp_path):
    out = str(tmp_path / "r.xlsx")

    def partly(s):
        df = stores(s, "8-20")
        df.rejected = s.createDataFrame([("u", "invalid json")], "url string, reason string")
        return df

    got = runner.run(spark, {"a": partly, "b": lambda s: s.createDataFrame([], ROW)}, out)
    assert got.exit_code == 0 and got.counts == {"stores": 1}
    assert spark.read.json(str(tmp_path / "r_rejected" / "a")).first().reason == "invalid json"


def test_interrupt_and_read_back(spark, tmp_path):
    import re
    import zipfile

    def stop(s):
        raise KeyboardInterrupt

    out = str(tmp_path / "r.xlsx")
    assert runner.run(spark, {"a": stop}, out).exit_code == 130
    runner.run(spark, {"a": lambda s: stores(s, "8-20")}, out)
    with zipfile.ZipFile(out) as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
    assert re.findall(r"<t [^>]*>([^<]*)</t>", sheet)[:2] == ["network", "region"] and "https://x.ru/shop/0" in sheet


def test_diff_of_two_tables(spark):
    from vitrine.functions.identity import canonical, stable_key

    side = lambda *h: stable_key(canonical(stores(spark, *h)))
    got = sorted((r.change_type, r.changed_fields) for r in diff(side("8-20", "9-21", "1-2"), side("8-22", "9-21"), "now").collect())
    assert got == [("changed", "work_time"), ("removed", None)]
    assert diff(side("8-20"), side("8-20").withColumn("collected_at", F.lit("later")), "now").count() == 0
