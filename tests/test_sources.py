import json

from pyspark.sql import functions as F

from vitrine.plans import runner
from vitrine.sources import html, jsonsource, mapscript


def test_json_chain(spark):
    body = json.dumps({"cities": [{"id": 5, "name": "Омск", "regionId": 2}, {"id": 5, "name": "Twice"}, {"id": 6, "address": "shop", "name": "x"}], "regions": [{"id": 2, "name": "Омская область"}]})
    cities = jsonsource.cities(spark.createDataFrame([(0, "broken"), (1, body)], "rank int, body string"))
    assert [tuple(r) for r in cities.select("city_id", "city", "region").collect()] == [(5, "Омск", "Омская область")]
    shops = json.dumps({"shops": [{"id": 9, "address": "ул. Мира, 1", "lon": "73.5", "workTime": {"week": ["8", "22"]}}, "no"]})
    r = jsonsource.shop_rows(jsonsource.shops(spark.createDataFrame([(5, shops)], "city_id long, body string")), cities, network="n", base_url="b").first()
    assert (r.city, r.region, r.work_time, r.latitude, r.longitude, r.source_url) == ("Омск", "Омская область", "8-22", None, 73.5, "b/api/cities/5/shops/#9")


def test_map_candidates(spark):
    script = "var shops = [{'address': 'Алтайский край, г. Барнаул, ул Попова, 1', 'lat': '52,54', 'lng': '85.5'},];"
    c = mapscript.candidates(spark.createDataFrame([(0, script)], "pos int, script string")).drop("script")
    r = mapscript.store_rows(c, network="n", map_url="m").first()
    assert (r.region, r.city, r.address, r.latitude) == ("Алтайский край", "Барнаул", "ул. Попова, 1", 52.54)
    assert r.source_url == "m#store=52.540000,85.500000"


def test_html_store_page(spark):
    page = '<dl><dt>Адрес</dt><dd>ул Мира, 3</dd><dt>Телефон</dt><dd>+7 1</dd></dl><meta property="place:location:latitude" content="55,1234"><meta property="place:location:longitude" content="60.5"><p>Режим работы: 8-22</p><footer>Тел: 8800</footer>'
    fields = html.store_page(F.col("page"))
    r = html.parse_pages(spark.createDataFrame([("u", page)], "url string, html string")).select(*[v.alias(k) for k, v in fields.items()]).first()
    assert (r.address, r.phone, r.latitude, r.work_time) == ("ул. Мира, 3", "+7 1", 55.1234, "08:00-22:00")


def test_run_twice_then_fail(spark, tmp_path):
    rows = lambda hours: lambda s: s.createDataFrame([("N", "https://x.ru/shop/1", hours), ("N", "https://x.ru/shop/2", "9-21")], "network string, source_url string, work_time string")
    out = str(tmp_path / "r.xlsx")
    first = runner.run(spark, {"a": rows("8-20")}, out)
    assert first.exit_code == 0 and first.initial and first.counts == {"stores": 2}
    second = runner.run(spark, {"a": rows("8-22")}, out)
    assert second.counts == {"changed": 1, "stores": 2} and second.changes.first().changed_fields == "work_time"

    def broken(s):
        raise ValueError("down")

    third = runner.run(spark, {"a": rows("1-2"), "b": broken}, out)
    assert third.exit_code == 1 and third.initial and third.failed == ["b"]
    assert runner.run(spark, {"a": rows("8-22")}, out).counts == {"stores": 2}
