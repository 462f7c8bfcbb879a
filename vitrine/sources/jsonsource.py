"""Cities and shops of a JSON API whose shape varies, over a table of fetched bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import keep_first

# --- fixed values: names under which the API gives a field, in order of precedence ---------------------------------
ADDRESS = ["address", "fullAddress", "shopAddress"]
FORMAT = ["format", "shopFormat", "shopType", "type"]
CITY = ["city", "cityName", "name", "town", "locality", "title"]
SHOP_CITY = ["city", "cityName", "town", "locality"]
CANDIDATE_CITY = ["name", "city", "cityName", "town", "locality"]
REGION = ["region", "regionName", "regionTitle", "region_name", "area", "district"]
NESTED_REGION = ["name", "title", "regionName"]
LATITUDE, LONGITUDE = ["latitude", "lat"], ["longitude", "lng", "lon"]
SHOP_LISTS = ["shops", "data", "items", "results"]
SHOP_MARKS = ["address", "fullAddress", "shopNum", "num", "cityId", "lat", "lng"]
REGION_MARKS = ["regionId", "region_id", "regionName", "region_name"]
# ------------------------------------------------------------------------------------------------------------------


def field(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def kind_of(v: Column, path: str | None = None) -> Column:
    """STRING, BIGINT, BOOLEAN, DOUBLE, DECIMAL(..), OBJECT<..>, ARRAY<..> or VOID; null where absent."""
    return F.schema_of_variant(v if path is None else field(v, path))


def text(v: Column, path: str) -> Column:
    """The trimmed string at a path; other types and blanks are null."""
    return F.when(kind_of(v, path) == "STRING", F.nullif(F.trim(field(v, path, "string")), F.lit("")))


def first_text(v: Column, names: list[str]) -> Column:
    return F.coalesce(*[text(v, n) for n in names])


def integer(v: Column, path: str) -> Column:
    """J14. An int, a truncated float or a string of digits; booleans and others are null."""
    k = kind_of(v, path)
    s = F.trim(field(v, path, "string"))
    return F.when(k == "BIGINT", field(v, path, "bigint")).when(k.rlike("^(DOUBLE|DECIMAL|FLOAT)"), field(v, path, "double").try_cast("bigint")).when((k == "STRING") & s.rlike("^[0-9]+$"), s.try_cast("bigint"))


def number(v: Column, names: list[str]) -> Column:
    """J9. The first name whose value reads as a number."""
    from ..functions.text import to_number

    return F.coalesce(*[F.when(~kind_of(v, n).rlike("^(ARRAY|OBJECT|BOOLEAN)"), to_number(field(v, n, "string"))) for n in names])


def items(v: Column) -> Column:
    """The elements of a list as variants; anything else is null."""
    return F.when(kind_of(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def work_time(v: Column) -> Column:
    """J4. A string; an object with a week (two ends, or text) or all, daily, value; a list of parts."""
    k = kind_of(v)
    week = F.try_variant_get(v, "$.week", "array<string>")
    whole = F.when(kind_of(v, "week").startswith("ARRAY") & (F.size(week) >= 2), F.concat_ws("-", week[0], week[1]))
    of_object = F.when(whole.isNotNull(), whole).when(kind_of(v, "week") == "STRING", text(v, "week")).otherwise(first_text(v, ["all", "daily", "value"]))
    parts = F.filter(F.transform(F.try_variant_get(v, "$", "array<string>"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(k == "STRING", F.nullif(F.trim(F.try_variant_get(v, "$", "string")), F.lit(""))).when(k.startswith("OBJECT"), of_object).when(k.startswith("ARRAY"), F.nullif(F.array_join(parts, "-"), F.lit("")))


def truthy(v: Column, path: str) -> Column:
    """The value at a path, null where it is absent, null, empty, zero or false."""
    x = field(v, path)
    s = field(v, path, "string")
    k = kind_of(v, path)
    empty = k.isin("VOID", "OBJECT<>") | k.startswith("ARRAY<VOID>") & (s == "[]") | s.isin("", "0", "0.0", "false") & ~((k == "STRING") & (s != "")) | (s == "[]")
    return F.when(~F.coalesce(empty, F.lit(True)), x)


def phone(v: Column) -> Column:
    """J5. A string `phone` as it is, blank or not; else the first of `phones` with text."""
    listed = F.get(F.filter(F.transform(F.try_variant_get(v, "$.phones", "array<string>"), lambda x: F.trim(x)), lambda x: x != ""), F.lit(0))
    return F.when(kind_of(v, "phone") == "STRING", text(v, "phone")).otherwise(listed)


def status(v: Column) -> Column:
    """J8."""
    flag = F.when(kind_of(v, "isActive") == "BOOLEAN", F.when(field(v, "isActive", "boolean"), "active").otherwise("inactive"))
    return F.coalesce(text(v, "status"), flag)


def region_name(v: Column) -> Column:
    """J12."""
    return F.coalesce(first_text(v, REGION), *[text(v, f"region.{n}") for n in NESTED_REGION])


def derived_region(v: Column) -> Column:
    """J13. An explicit name, a nested one, or the region's number."""
    ident = F.coalesce(truthy(v, "regionId"), field(v, "region_id"))
    s = F.trim(F.try_variant_get(ident, "$", "string"))
    shown = F.when(kind_of(ident).rlike("^(DOUBLE|DECIMAL|FLOAT)"), s.try_cast("double").cast("bigint").cast("string")).otherwise(s)
    return F.coalesce(text(v, "regionName"), text(v, "region_name"), text(v, "region.name"), F.when(shown != "", F.concat(F.lit("Регион #"), shown)))


def is_city(v: Column) -> Column:
    """J2. Has a number and a name, and isn't a shop."""
    has = lambda names: F.greatest(*[field(v, n).isNotNull() for n in names])
    return F.coalesce(kind_of(v).startswith("OBJECT") & integer(v, "id").isNotNull() & first_text(v, CANDIDATE_CITY).isNotNull() & ~(has(SHOP_MARKS) & ~has(REGION_MARKS)), F.lit(False))


def listed(body: Column) -> Column:
    """J1. The list of a payload: itself, `cities`, or those under data, result, items; the first counts. No list: null."""
    tries = [items(body), items(field(body, "cities"))]
    for k in ("data", "result", "items"):
        tries += [items(field(body, f"{k}.cities")), items(field(body, k))]
    return F.coalesce(*tries)


def city_list(body: Column) -> Column:
    """J1, J2. The city elements of a payload."""
    return F.filter(F.coalesce(listed(body), F.array().cast("array<variant>")), is_city)


def cities(endpoints: DataFrame) -> DataFrame:
    """S5, J1-J3, X1, D1. (city_id, city, region) of the first endpoint, by rank, with any city. endpoints: (rank int, body string)."""
    parsed = endpoints.select("rank", F.try_parse_json("body").alias("v"))
    listed = parsed.select("rank", "v", F.posexplode(city_list(F.col("v"))).alias("pos", "c"))
    best = listed.agg(F.min("rank").alias("rank"))
    listed = listed.join(F.broadcast(best), "rank")  # one row
    regions = parsed.join(F.broadcast(best), "rank").select(F.posexplode(items(field(F.col("v"), "regions"))).alias("pos", "r"))
    name = F.when(kind_of(F.col("r"), "name") == "STRING", text(F.col("r"), "name")).otherwise(text(F.col("r"), "title"))
    lookup = regions.select("pos", integer(F.col("r"), "id").alias("region_id"), name.alias("name")).where("region_id is not null and name is not null").groupBy("region_id").agg(F.max_by("name", "pos").alias("mapped"))
    c = F.col("c")
    rid = F.coalesce(F.when(truthy(c, "regionId").isNotNull(), integer(c, "regionId")), F.when(truthy(c, "regionId").isNull(), integer(c, "region_id")))
    rows = listed.select("pos", integer(c, "id").alias("city_id"), first_text(c, CITY).alias("city"), text(c, "regionName").alias("own"), region_name(c).alias("named"), derived_region(c).alias("derived"), rid.alias("region_id")).join(lookup, "region_id", "left")
    rows = rows.withColumn("region", F.when(F.col("own").isNull() & F.col("mapped").isNotNull(), F.coalesce(F.when(F.col("named").isNotNull(), F.col("named")), "mapped")).otherwise(F.coalesce("named", "derived")))
    return keep_first(rows, [F.col("city_id")], [F.col("pos")]).select("city_id", "city", "region", "pos")


def nameless_cities(endpoints: DataFrame) -> DataFrame:
    """P8. (url, reason): the elements of city lists with a name but without an id, which are left out."""
    c = endpoints.select(F.explode(listed(F.try_parse_json("body"))).alias("c"))
    bad = kind_of(F.col("c")).startswith("OBJECT") & integer(F.col("c"), "id").isNull() & first_text(F.col("c"), CANDIDATE_CITY).isNotNull()
    return c.where(bad).select(F.concat(F.lit("city "), first_text(F.col("c"), CANDIDATE_CITY)).alias("url"), F.lit("no id").alias("reason"))


def shops(bodies: DataFrame) -> DataFrame:
    """S6. (city_id, pos, shop variant) of bodies (city_id, body): a list, or the first list under known names."""
    v = F.try_parse_json("body")
    listed = F.coalesce(items(F.col("v")), *[items(field(F.col("v"), k)) for k in SHOP_LISTS])
    rows = bodies.select("city_id", v.alias("v")).select("city_id", F.posexplode(listed).alias("pos", "shop"))
    return rows.where(kind_of(F.col("shop")).startswith("OBJECT"))


def shop_rows(shop: DataFrame, city: DataFrame, *, network: str, base_url: str) -> DataFrame:
    """J15, X2. Store-like rows: a shop's own place first, then its city's."""
    s = F.col("shop")
    ident = F.try_variant_get(F.coalesce(truthy(s, "id"), field(s, "shopId")), "$", "string")
    url = F.concat(F.lit(f"{base_url}/api/cities/"), F.col("city_id").cast("string"), F.lit("/shops/"))
    j = shop.join(city.select("city_id", F.col("city").alias("__city"), F.col("region").alias("__region"), F.col("pos").alias("city_pos")), "city_id")
    return j.select(
        "city_pos", "pos", F.lit(network).alias("network"), F.coalesce(region_name(s), "__region").alias("region"), F.coalesce(first_text(s, SHOP_CITY), "__city").alias("city"), first_text(s, ADDRESS).alias("address"),
        work_time(F.coalesce(truthy(s, "workTime"), field(s, "work_time"))).alias("work_time"), number(s, LATITUDE).alias("latitude"), number(s, LONGITUDE).alias("longitude"), phone(s).alias("phone"), first_text(s, FORMAT).alias("store_format"), status(s).alias("status"),
        F.when(ident.isNotNull(), F.concat(url, F.lit("#"), ident)).otherwise(url).alias("source_url"),
    )
