"""Store-shaped views of the driver tables, in DataFrame and SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import spread

COLLECTED = "2026-01-01T00:00:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, over many tasks: what the queries make of a customer costs far more than reading it."""
    return spread(table(spark, sf_dir, "customer"), "c_custkey")


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store a customer, with untidy text; key c_custkey."""
    c, n, r = customers(spark, sf_dir), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    j = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    url = F.when(k % 3 == 0, "https://shops.example.com/list").when(k % 3 == 1, F.concat(F.lit("https://shops.example.com/store/"), k)).otherwise(F.concat(F.lit("https://www.monetka.ru/ural/shops_map/"), F.lower("n_name"), F.lit("/"), k, F.lit("/")))
    return j.select(
        "c_custkey", F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ,")).alias("network"), F.when(k % 7 == 0, "n/a").otherwise(F.col("r_name")).alias("region"), F.col("n_name").alias("city"), F.concat(F.col("n_name"), F.lit(" ,  ул. "), F.col("c_name"), F.lit(" ; ")).alias("address"),
        F.when(k % 5 == 0, " ").otherwise(F.concat((k % 4 + 7).cast("string"), F.lit(":00-22:00"))).alias("work_time"), F.when(k % 11 == 0, "none").otherwise(F.concat(F.floor(F.abs(F.col("c_acctbal")) % 90).cast("string"), F.lit(".25"))).alias("latitude"), F.when(k % 13 == 0, "abc").otherwise(F.concat(F.floor(F.abs(F.col("c_acctbal")) % 180).cast("string"), F.lit(".5"))).alias("longitude"),
        F.lit(None).cast("string").alias("phone"), F.when(k % 2 == 0, "Market").alias("store_format"), F.lit("active").alias("status"), url.alias("source_url"), F.lit(COLLECTED).alias("collected_at"),
    )


RAW = f"""
raw as (select c_custkey, '  ' || c_mktsegment || ' ,' as network, case when c_custkey % 7 = 0 then 'n/a' else r_name end as region, n_name as city, n_name || ' ,  ул. ' || c_name || ' ; ' as address,
 case when c_custkey % 5 = 0 then ' ' else (c_custkey % 4 + 7)::varchar || ':00-22:00' end as work_time,
 case when c_custkey % 11 = 0 then 'none' else floor(abs(c_acctbal) % 90)::bigint::varchar || '.25' end as latitude,
 case when c_custkey % 13 = 0 then 'abc' else floor(abs(c_acctbal) % 180)::bigint::varchar || '.5' end as longitude,
 null::varchar as phone, case when c_custkey % 2 = 0 then 'Market' end as store_format, 'active' as status,
 case c_custkey % 3 when 0 then 'https://shops.example.com/list' when 1 then 'https://shops.example.com/store/' || c_custkey else 'https://www.monetka.ru/ural/shops_map/' || lower(n_name) || '/' || c_custkey || '/' end as source_url,
 '{COLLECTED}' as collected_at
 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def sql_text(x: str) -> str:
    """N1."""
    s = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'), ' ' || chr(9) || chr(13) || chr(10) || ',;')"
    return f"(case when {s} <> '' and lower({s}) not in ('none', 'null', 'nan', 'n/a', '-') then {s} end)"


def sql_token(x: str) -> str:
    """N2."""
    return f"coalesce(regexp_replace(lower({sql_text(x)}), '[^0-9a-zа-яё]+', '', 'g'), '')"


def sql_number(x: str) -> str:
    return f"(case when regexp_matches(trim({x}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') then try_cast(trim({x}) as double) end)"


def sql_compare_url(x: str) -> str:
    pattern = "(?i)https?://(?:www\\.)?monetka\\.ru/(?:[^/]+/)?shops_map/[^/]+/([0-9]+)/?$"
    return f"(case when regexp_extract({x}, '{pattern}', 1) <> '' then 'monetka-store:' || regexp_extract({x}, '{pattern}', 1) else {x} end)"


_ADDRESS = f"regexp_replace(regexp_replace({sql_text('address')}, '\\s+,', ',', 'g'), ',\\s*,+', ', ', 'g')"
#: The city goes where it leads the address; here what follows always has a street marker.
CANONICAL = f"""{RAW},
clean as (select c_custkey, coalesce({sql_text('network')}, '') as network, {sql_text('region')} as region, {sql_text('city')} as city, {_ADDRESS} as a0, {sql_text('work_time')} as work_time, {sql_number('latitude')} as latitude, {sql_number('longitude')} as longitude,
 {sql_text('phone')} as phone, {sql_text('store_format')} as store_format, {sql_text('status')} as status, coalesce({sql_text('source_url')}, '') as source_url, {sql_text('collected_at')} as collected_at from raw),
stores as (select * exclude (a0), case when {sql_token("split_part(a0, ',', 1)")} = {sql_token('city')} and trim(substr(a0, strpos(a0, ',') + 1)) <> '' and strpos(a0, ',') > 0 then trim(substr(a0, strpos(a0, ',') + 1)) else a0 end as address from clean)"""

_URL = sql_compare_url("source_url")
KEYED = f"""{CANONICAL},
k as (select *, {_URL} as u from stores),
k2 as (select *, not (starts_with(u, 'monetka-store:') or contains(u, '#') or regexp_matches(u, '/[0-9]+/?$') or contains(lower(u), 'store=') or contains(lower(u), 'shop=')) as place from k),
keyed as (select * exclude (u, place), sha1(concat_ws('||', 'network:' || {sql_token('network')}, 'url:' || u, case when latitude is not null and longitude is not null then printf('coords:%.6f,%.6f', latitude, longitude) end,
 case when place and {sql_token('region')} <> '' then 'region:' || {sql_token('region')} end, case when place and {sql_token('city')} <> '' then 'city:' || {sql_token('city')} end, case when place and {sql_token('address')} <> '' then 'address:' || {sql_token('address')} end)) as stable_key from k2)"""
