"""Registered queries over the driver tables, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import identity, links, places, text, worktime
from ..functions.identity import canonical, stable_key
from ..operators import dedup, diff, enrich, report
from ..schemas import ORDER_FIELDS, STORE_COLUMNS, TRACKED_FIELDS
from ..shared import drop, put, shared_folder
from ..sources import html, snapshot
from .views import CANONICAL, KEYED, customers, raw_stores, sql_compare_url, sql_number, sql_text, sql_token, table

DETECTED = "2026-01-02T00:00:00+00:00"
_QUERIES, _SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def stores(spark, d):
    return canonical(raw_stores(spark, d), keep=("c_custkey",))


def keyed(spark, d):
    return stable_key(stores(spark, d))


@query(f"with {CANONICAL} select c_custkey, {', '.join(STORE_COLUMNS)} from stores")
def store_normalize(spark, d):
    return stores(spark, d)


@query(f"with {KEYED} select c_custkey, stable_key from keyed")
def stable_keys(spark, d):
    return keyed(spark, d).select("c_custkey", "stable_key")


@query(f"select doc_id, {sql_text('text')} as cleaned from documents")
def text_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", text.optional_text(F.col("text")).alias("cleaned"))


@query(f"select doc_id, {sql_token('text')} as token, coalesce(regexp_replace(lower(text), '[^0-9a-zа-я]+', '', 'g'), '') as bare from documents")
def text_token(spark, d):
    return table(spark, d, "documents").select("doc_id", text.text_token(F.col("text")).alias("token"), text.bare_token(F.col("text")).alias("bare"))


@query(f"""with x as (select c_custkey, case c_custkey % 4 when 0 then ' ' || (c_custkey % 90)::varchar || ',5 ' when 1 then 'abc' when 2 then (c_custkey % 180)::varchar || '.25' else (c_custkey % 9)::varchar || ' шт' end as s from customer)
select c_custkey, {sql_number('s')} as plain, {sql_number("replace(s, ',', '.')")} as comma, {sql_number("regexp_replace(replace(s, ',', '.'), '[^0-9.-]', '', 'g')")} as loose from x""")
def coord_parse(spark, d):
    k = F.col("c_custkey")
    s = F.when(k % 4 == 0, F.concat(F.lit(" "), k % 90, F.lit(",5 "))).when(k % 4 == 1, "abc").when(k % 4 == 2, F.concat(k % 180, F.lit(".25"))).otherwise(F.concat(k % 9, F.lit(" шт")))
    x = customers(spark, d).select("c_custkey", s.alias("s"))
    return x.select("c_custkey", text.to_number(F.col("s")).alias("plain"), text.to_number_comma(F.col("s")).alias("comma"), text.to_number_loose(F.col("s")).alias("loose"))


@query("""with x as (select s_suppkey, (case s_suppkey % 6 when 0 then 'Адрес: у ул ' when 1 then 'ул ' when 2 then 'пр кт ' when 3 then 'пер ' when 4 then 'у ' else 'просп ' end) || s_name || ' , ,' || s_suppkey as a from supplier),
s as (select s_suppkey, trim(regexp_replace(a, '\\s+', ' ', 'g'), ' ,;') as a from x),
r1 as (select s_suppkey, regexp_replace(a, '(?i)^адрес\\s*[:\\-]?\\s*', '') as a from s),
r2 as (select s_suppkey, regexp_replace(regexp_replace(a, '(?i)^у\\s+ул\\.?\\s*', 'ул. '), '(?i)^у\\s+', '') as a from r1),
r3 as (select s_suppkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(a, '(?i)^ул\\s+', 'ул. '), '(?i)^пер\\s+', 'пер. '), '(?i)^пр[- ]?кт\\s+', 'пр-кт '), '(?i)^просп\\s+', 'просп. ') as a from r2)
select s_suppkey, trim(regexp_replace(regexp_replace(regexp_replace(a, '\\s+,', ',', 'g'), ',\\s*,+', ', ', 'g'), '\\s{2,}', ' ', 'g'), ' ,;') as address from r3""")
def address_street_rewrite(spark, d):
    k = F.col("s_suppkey") % 6
    lead = F.when(k == 0, "Адрес: у ул ").when(k == 1, "ул ").when(k == 2, "пр кт ").when(k == 3, "пер ").when(k == 4, "у ").otherwise("просп ")
    return table(spark, d, "supplier").select("s_suppkey", places.page_address(F.concat(lead, F.col("s_name"), F.lit(" , ,"), F.col("s_suppkey"))).alias("address"))


@query("""with x as (select event_id, hour(ts)::varchar || case when event_id % 3 = 0 then '.30' when event_id % 3 = 1 then '' else ':15' end as a, ((hour(ts) + 9) % 24)::varchar as b from events),
n as (select event_id, lpad(split_part(replace(a, '.', ':'), ':', 1), 2, '0') || ':' || case when contains(replace(a, '.', ':'), ':') then split_part(replace(a, '.', ':'), ':', 2) else '00' end || '-' || lpad(b, 2, '0') || ':00' as t from x)
select event_id, t as cleaned, t as found from n""")
def worktime_normalize(spark, d):
    k = F.col("event_id") % 3
    a = F.concat(F.hour("ts").cast("string"), F.when(k == 0, ".30").when(k == 1, "").otherwise(":15"))
    s = F.concat(a, F.lit(" — "), ((F.hour("ts") + 9) % 24).cast("string"))
    return table(spark, d, "events").select("event_id", worktime.clean_work_time(s).alias("cleaned"), worktime.find_work_time(F.concat(F.lit("Открыто "), s, F.lit(" ежедневно"))).alias("found"))


@query("""select event_id, case event_id % 4 when 0 then '8-' || (event_id % 12 + 12) when 1 then 'daily' when 2 then 'a-b' else 'пн' end as work_time, case event_id % 3 when 0 then '+7' when 1 then null else '8' end as phone,
case event_id % 4 when 0 then 'on' when 1 then 'active' when 2 then 'inactive' end as status, event_id % 1000 as number from events""")
def shop_fields(spark, d):
    """J4, J5, J8, J14 over JSON of several shapes."""
    from ..sources import jsonsource as J

    k = F.col("event_id")
    hours = F.when(k % 4 == 0, F.concat(F.lit('{"week":["8","'), k % 12 + 12, F.lit('"]}'))).when(k % 4 == 1, '{"daily":" daily "}').when(k % 4 == 2, '["a"," b ",""]').otherwise('" пн "')
    phone = F.when(k % 3 == 0, '"phones":[" ","+7"]').when(k % 3 == 1, '"phone":" ","phones":["9"]').otherwise('"phone":"8 "')
    state = F.when(k % 4 == 0, '"status":" on "').when(k % 4 == 1, '"isActive":true').when(k % 4 == 2, '"status":"","isActive":false').otherwise('"status":5')
    ident = F.when(k % 3 == 0, F.concat(F.lit('" '), k % 1000, F.lit(' "'))).when(k % 3 == 1, (k % 1000).cast("string")).otherwise(F.concat(k % 1000, F.lit(".5")))
    body = F.concat(F.lit('{"workTime":'), hours, F.lit(","), phone, F.lit(","), state, F.lit(',"id":'), ident, F.lit("}"))
    v = table(spark, d, "events").select("event_id", F.try_parse_json(body).alias("v"))
    return v.select("event_id", J.work_time(J.field(F.col("v"), "workTime")).alias("work_time"), J.phone(F.col("v")).alias("phone"), J.status(F.col("v")).alias("status"), J.integer(F.col("v"), "id").alias("number"))


_HOST = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)"


@query(f"select page_id, {sql_compare_url('url')} as compare_url, (contains(url, '#') or regexp_matches(url, '/[0-9]+/?$') or contains(lower(url), 'store=') or contains(lower(url), 'shop=')) as specific, regexp_replace(url, '#.*$', '') as plain from pages")
def url_keys(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", identity.compare_url(u).alias("compare_url"), identity.specific_url(u).alias("specific"), links.without_fragment(u).alias("plain"))


@query(f"""with a as (select page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href from pages),
r as (select *, case when starts_with(href, 'http') then href else regexp_extract(url, '^(https?://[^/?#]*)', 1) || href end as full_url from a),
c as (select page_id, case when trim(href) = '' then 'empty' when starts_with(href, '+') then 'starts_with_plus' when starts_with(href, '#') then 'starts_with_hash' when starts_with(lower(href), 'javascript:') then 'javascript_link'
 when not regexp_matches(full_url, '(?i)^https?://') then 'unsupported_scheme' when regexp_extract(full_url, '^[a-zA-Z]+://([^/?#]*)', 1) <> 'example.com' then 'foreign_domain' else 'invalid_city_path' end as reason from r)
select page_id, reason, count(*) as n from c group by all""")
def href_classify(spark, d):
    """P2, P3, G5 over the anchors of every page."""
    a = html.anchors(html.parse_pages(table(spark, d, "pages"), fields=html.PAGE_LINKS), "page_id")
    return a.select("page_id", F.coalesce(links.href_reject_reason(F.col("href"), F.col("url"), "example.com"), F.lit("accepted")).alias("reason")).groupBy("page_id", "reason").agg(F.count("*").alias("n"))


@query("""select page_id, html_n as n_links, h1 from (select page_id, len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as html_n, trim(replace(replace(replace(replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&')) as h1 from pages)""")
def page_headings(spark, d):
    """H6's heading and P6's count. A page without a heading has an empty one, a null page none of either."""
    p = html.parse_pages(table(spark, d, "pages"), fields=("h1", "anchors.href"))
    there = lambda c: F.when(F.col("html").isNotNull(), c)
    return p.select("page_id", there(F.size("page.anchors").cast("long")).alias("n_links"), there(F.coalesce("page.h1", F.lit(""))).alias("h1"))


def _copies(df):
    """Each store, and for two in five a poorer copy that comes earlier."""
    poor = df.where("c_custkey % 5 < 2").withColumns({"work_time": F.lit(None).cast("string"), "store_format": F.lit(None).cast("string"), "c_custkey": -F.col("c_custkey")})
    return df.unionByName(poor)


_COPIES = f"{KEYED}, copies as (select * from keyed union all by name select -c_custkey as c_custkey, * exclude (c_custkey) replace (null as work_time, null as store_format) from keyed where c_custkey % 5 < 2)"
_FILLED = " + ".join(f"(coalesce({c}::varchar, '') <> '')::bigint" for c in ORDER_FIELDS)
_TEXTS = [f"coalesce(case when {c} = 0 then '' else {c}::varchar end, '')" if c in ("latitude", "longitude") else f"coalesce({c}, '')" for c in [*ORDER_FIELDS, "stable_key"]]


@query(f"with {KEYED} select c_custkey, {_FILLED} as filled from keyed")
def completeness(spark, d):
    return keyed(spark, d).select("c_custkey", dedup.completeness().alias("filled"))


@query(f"with {_COPIES} select c_custkey, stable_key, work_time from copies qualify row_number() over (partition by stable_key order by {_FILLED} desc, {', '.join(t + ' desc' for t in _TEXTS)}, collected_at desc, c_custkey desc) = 1")
def dedup_best(spark, d):
    return dedup.keep_best(_copies(keyed(spark, d)), F.struct("collected_at", "c_custkey")).select("c_custkey", "stable_key", "work_time")


@query(f"with {_COPIES} select stable_key, count(*) - 1 as duplicates, count(distinct coalesce(work_time, '~') || '|' || coalesce(store_format, '~')) > 1 as conflicting from copies group by stable_key having count(*) > 1")
def dedup_conflicts(spark, d):
    return dedup.conflicts(_copies(keyed(spark, d)))


def _by_place(df):
    return df.withColumns({"city": F.when(F.col("c_custkey") % 4 > 0, F.col("city")), "address": F.when(F.col("c_custkey") % 4 > 1, F.concat(F.lit("Дом "), F.col("c_custkey") % 9))})


_PLACE = f"with {CANONICAL}, p as (select c_custkey, network, case when c_custkey % 4 > 0 then city end as city, case when c_custkey % 4 > 1 then 'Дом ' || c_custkey % 9 end as address, source_url from stores), q as (select *, lower(network) as a, lower(coalesce(city, '')) as b, lower(coalesce(address, '')) as c from p) select c_custkey from q qualify row_number() over (partition by a, b, c{{}} order by c_custkey) = 1"


@query(_PLACE.format(""))
def dedup_first(spark, d):
    return dedup.keep_first(_by_place(stores(spark, d)), dedup.location_keys(url_fallback=False), [F.col("c_custkey")]).select("c_custkey")


@query(_PLACE.format(", case when b = '' and c = '' then lower(source_url) else '' end"))
def dedup_first_fallback(spark, d):
    return dedup.keep_first(_by_place(stores(spark, d)), dedup.location_keys(url_fallback=True), [F.col("c_custkey")]).select("c_custkey")


@query("select o_custkey, o_orderstatus, o_orderpriority from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1")
def first_context(spark, d):
    o = table(spark, d, "orders")
    return enrich.first_context(o, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@query("select n_name as city, n_regionkey as region_id, case when n_nationkey % 3 = 0 then 'own ' || n_nationkey else r_name end as region_name from nation left join region on n_regionkey = r_regionkey and r_regionkey <> 4")
def region_lookup_join(spark, d):
    n = table(spark, d, "nation").select(F.col("n_name").alias("city"), F.col("n_regionkey").alias("region_id"), F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("own "), F.col("n_nationkey"))).otherwise(" ").alias("region_name"))
    r = table(spark, d, "region").where("r_regionkey <> 4").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return enrich.fill_region(n, r)


@query("""with x as (select c_custkey, case when c_custkey % 3 > 0 then n_name end as c, case when c_custkey % 5 > 1 then 'R' || c_custkey % 2 end as r, case when c_custkey % 7 > 0 then lower(n_name) else 'Else' end as cc, case when c_custkey % 4 > 0 then 'r1' end as cr from customer join nation on c_nationkey = n_nationkey),
t as (select *, coalesce(lower(c) <> lower(cc), false) as wc, coalesce(lower(r) <> lower(cr), false) as wr from x)
select c_custkey, case when wc or wr then c else coalesce(c, cc) end as city, case when wc or wr then r else coalesce(r, cr) end as region from t""")
def context_backfill(spark, d):
    k = F.col("c_custkey")
    j = customers(spark, d).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    s = enrich.backfill(F.when(k % 3 > 0, F.col("n_name")), F.when(k % 5 > 1, F.concat(F.lit("R"), k % 2)), F.when(k % 7 > 0, F.lower("n_name")).otherwise("Else"), F.when(k % 4 > 0, "r1"))
    return j.select("c_custkey", s.alias("s")).select("c_custkey", "s.city", "s.region")


@query("""with s as (select doc_id as url, case when doc_id % 4 > 0 then source end as city, case when doc_id % 10 > 0 then 'ул. ' || doc_id end as address, case when doc_id % 3 = 0 then '8-21' end as hours, case when doc_id % 7 = 0 then 'f' || doc_id end as phone from documents),
j as (select *, l.doc_id is not null as hit from s left join labels l on l.doc_id = url),
x as (select url, hit, case when not hit then city when quality = 1 then 'Город ' || source_len else city end as city, case when hit and quality = 0 then 'пер. ' || url else address end as address, case when hours is not null then '08:00-21:00' when hit and toxic = 1 then '09:00-22:00' end as work_time, phone from (select *, length(coalesce(city, '')) as source_len from j))
select url, case when hit then 'parsed' when coalesce(city, address, work_time, phone) is not null then 'partial' else 'skipped' end as outcome, city, address, work_time, phone from x""")
def detail_fallback(spark, d):
    """A field that the detail page lacks comes from the summary, one by one; a page that wasn't read leaves the summary."""
    none, k = F.lit(None).cast("string"), F.col("doc_id")
    s = table(spark, d, "documents").select(k.alias("url"), F.when(k % 4 > 0, F.col("source")).alias("city"), none.alias("region"), F.when(k % 10 > 0, F.concat(F.lit("ул "), k)).alias("address"), F.when(k % 3 == 0, "8-21").alias("work_time"), F.when(k % 7 == 0, F.concat(F.lit("f"), k)).alias("phone"), none.alias("store_format"))
    size = s.select(F.col("url").alias("__u"), F.char_length(F.coalesce("city", F.lit(""))).alias("__n"))
    t = table(spark, d, "labels").join(size, k == F.col("__u"))
    t = t.select(k.alias("url"), F.when(F.col("quality") == 1, F.concat(F.lit("Город "), F.col("__n"))).alias("city"), none.alias("region"), F.when(F.col("quality") == 0, F.concat(F.lit("пер "), k)).alias("address"), F.when((F.col("toxic") == 1) & (k % 3 > 0), "9 — 22").alias("work_time"), F.lit(" ").alias("phone"), none.alias("store_format"))
    return enrich.with_detail(s, t).select("url", "outcome", "city", "address", "work_time", "phone")


def _two(spark, d):
    """The baseline lacks a tenth of the stores, the current snapshot another; work times of a sixth and urls' paths have moved."""
    x = keyed(spark, d)
    k = F.col("c_custkey")
    previous = x.where(k % 10 != 1)
    current = x.where(k % 10 != 2).withColumns({"work_time": F.when(k % 6 == 0, "24/7").otherwise(F.col("work_time")), "source_url": F.replace(F.col("source_url"), F.lit("/ural/"), F.lit("/"))})
    return previous, current


_FULL = ", ".join(f"{c} := {c}" for c in sorted(STORE_COLUMNS))
_DIFF = f"""{KEYED},
best as (select *, {_FILLED} as filled from keyed),
p as (select * from best where c_custkey % 10 <> 1 qualify row_number() over (partition by stable_key order by filled desc, {', '.join(t + ' desc' for t in _TEXTS)}, collected_at desc) = 1),
c0 as (select * replace (case when c_custkey % 6 = 0 then '24/7' else work_time end as work_time, replace(source_url, '/ural/', '/') as source_url) from keyed where c_custkey % 10 <> 2),
c as (select *, {_FILLED} as filled from c0 qualify row_number() over (partition by stable_key order by {_FILLED} desc, {', '.join(t + ' desc' for t in _TEXTS)}, collected_at desc) = 1),
j as (select coalesce(p.stable_key, c.stable_key) as stable_key, p, c, p.stable_key is null as no_p, c.stable_key is null as no_c from p full join c on p.stable_key = c.stable_key),
f as (select *, case when not no_p and not no_c then list_filter([{', '.join(f"case when p.{x} is distinct from c.{x} then '{x}' end" if x != 'source_url' else f"case when {sql_compare_url('p.source_url')} is distinct from {sql_compare_url('c.source_url')} then 'source_url' end" for x in TRACKED_FIELDS)}], lambda z: z is not null) end as fields from j),
changes as (select stable_key, case when no_p then 'added' when no_c then 'removed' else 'changed' end as change_type, case when no_c then p.network else c.network end as network, case when no_c then p.region else c.region end as region, case when no_c then p.city else c.city end as city,
 case when no_c then p.address else c.address end as address, case when no_c then p.source_url else c.source_url end as source_url, nullif(array_to_string(fields, ','), '') as changed_fields,
 case when not no_p and not no_c then p.work_time end as old_time, case when not no_p and not no_c then c.work_time end as new_time, '{DETECTED}' as detected_at from f where fields is null or len(fields) > 0)"""


def _sides(spark, d):
    """Both snapshots in one table: stores are made canonical and keyed once, then stand on one side or both."""
    k = F.col("c_custkey")
    x = keyed(spark, d).withColumn("side", F.explode(F.array_compact(F.array(F.when(k % 10 != 1, "p"), F.when(k % 10 != 2, "c")))))
    now = F.col("side") == "c"
    return x.withColumns({"work_time": F.when(now & (k % 6 == 0), "24/7").otherwise(F.col("work_time")), "source_url": F.when(now, F.replace(F.col("source_url"), F.lit("/ural/"), F.lit("/"))).otherwise(F.col("source_url"))})


def _diff(spark, d):
    return diff.diff_sides(_sides(spark, d), DETECTED)


def _changes(spark, d):
    return _shown(_diff(spark, d))


def _shown(x):
    was = lambda c: F.when(F.col("change_type") == "changed", F.get_json_object(c, "$.work_time"))
    return x.select("stable_key", "change_type", "network", "region", "city", "address", "source_url", "changed_fields", was("old_value").alias("old_time"), was("new_value").alias("new_time"), "detected_at")


@query(f"with {_DIFF} select * from changes")
def diff_all(spark, d):
    return _changes(spark, d)


@query(f"with {_DIFF} select * from changes")
def diff_snapshots(spark, d):
    """As diff_all, of two tables: each side is made canonical and keyed on its own, as a run has them."""
    return _shown(diff.diff(*_two(spark, d), DETECTED))


@query(f"with {_DIFF} select * from changes")
def diff_versions(spark, d):
    """As diff_all, of two stored versions in the shared folder, from the digests of their slices down. Stores are made canonical and keyed once for both."""
    path, both = f"{shared_folder(spark)}/vitrine-versions-{uuid.uuid4().hex}", put(diff.best_sides(_sides(spark, d)))
    previous, current = (spark.read.parquet(both).where(F.col(n).isNotNull()).select(f"{n}.*", "stable_key") for n in "pc")
    first = snapshot.write(previous, path, DETECTED)
    second = snapshot.write(current, path, DETECTED, like=first)
    drop(spark, both)
    return _shown(snapshot.diff_stored(spark, first, second, DETECTED))


@query(f"with {_DIFF} select * from changes where change_type = 'added'")
def diff_added(spark, d):
    return _changes(spark, d).where("change_type = 'added'")


@query(f"with {_DIFF} select * from changes where change_type = 'removed'")
def diff_removed(spark, d):
    return _changes(spark, d).where("change_type = 'removed'")


@query(f"with {_DIFF} select * from changes where change_type = 'changed'")
def diff_changed(spark, d):
    return _changes(spark, d).where("change_type = 'changed'")


@query(f"with {_DIFF} select * from changes where false")
def diff_initial(spark, d):
    none = F.lit(None).cast("string")
    return diff.diff(*_two(spark, d), DETECTED, initial=True).select("stable_key", "change_type", "network", "region", "city", "address", "source_url", "changed_fields", none.alias("old_time"), none.alias("new_time"), "detected_at")


_PAYLOAD = f"""with {_DIFF}, a as (select stable_key, unnest([{', '.join(f"struct_pack(k := '{c}', v := c.{c}::varchar)" for c in STORE_COLUMNS)}]) as e from f where no_p)
select stable_key, e.k as field, e.v as value from a where e.v is not null"""


@query(_PAYLOAD)
def diff_payload(spark, d):
    """The payload of added stores, field by field."""
    x = _diff(spark, d).where("change_type = 'added'")
    m = x.select("stable_key", F.explode(F.from_json("new_value", "map<string,string>")).alias("field", "value"))
    return m.where("value is not null")


@query(f"with {_DIFF} select change_type, count(*) as n from changes group by 1")
def change_counts(spark, d):
    return diff.change_counts(diff.diff(*_two(spark, d), DETECTED))  # two tables, as a run has them


@query(f"with {_DIFF} select stable_key, row_number() over (order by case change_type when 'added' then 0 when 'removed' then 1 else 2 end, coalesce(network, ''), coalesce(city, ''), coalesce(address, ''), stable_key) as place from changes")
def change_order(spark, d):
    return report.ranked(_diff(spark, d), diff.change_order()).select("stable_key", "place")


@query(f"with {CANONICAL} select network, count(*) as stores_count from stores group by 1")
def network_stats(spark, d):
    return report.network_stats(stores(spark, d))


@query(f"with {KEYED} select c_custkey, row_number() over (order by network nulls last, region nulls last, city nulls last, address nulls last, source_url nulls last, {', '.join(_TEXTS)}, c_custkey) as place from keyed")
def data_sheet_order(spark, d):
    return report.ranked(keyed(spark, d), [*report.data_order(), F.col("c_custkey")]).select("c_custkey", "place")


@query(f"with {KEYED} select c_custkey, row_number() over (order by {', '.join(_TEXTS)}, c_custkey) as place from keyed")
def snapshot_order(spark, d):
    return report.ranked(keyed(spark, d), [*report.snapshot_order(), F.col("c_custkey")]).select("c_custkey", "place")


@query(f"with {KEYED} select c_custkey, row_number() over (order by {', '.join(t for t, c in zip(_TEXTS, [*ORDER_FIELDS, 'stable_key']) if c != 'stable_key')}, c_custkey) as place from keyed")
def map_store_order(spark, d):
    """O3, with ranges of few rows."""
    return report.ranked(keyed(spark, d), [*report.business_order(), F.col("c_custkey")]).select("c_custkey", "place")


@query("select 0 as chain, c_custkey as id, c_name as name from customer union all select 1, s_suppkey, s_name from supplier")
def union_sources(spark, d):
    a = table(spark, d, "customer").select(F.lit(0).alias("chain"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return a.unionByName(table(spark, d, "supplier").select(F.lit(1).alias("chain"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderkey) <= 20")
def page_cap(spark, d):
    return report.cap(table(spark, d, "orders"), [F.col("o_custkey")], [F.col("o_orderkey")], 20).select("o_custkey", "o_orderkey")


@query("""with e as (select event_id, user_id, case event_type when 'purchase' then 0 when 'click' then 1 else 2 end as rank from events) select event_id, user_id, rank from e qualify rank = min(rank) over (partition by user_id)""")
def strategy_select(spark, d):
    e = table(spark, d, "events")
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    return report.first_strategy(e.select("event_id", "user_id", rank.alias("rank")), "rank", ["user_id"]).select("event_id", "user_id", "rank")


@query(f"with {CANONICAL}, " + ", ".join(f"w{i} as (select '{c}' as \"column\", least(greatest(greatest(coalesce(max(length({c}::varchar)), 0), {len(c)}) + 2, 12), 80)::bigint as width from stores)" for i, c in enumerate(STORE_COLUMNS)) + " " + " union all ".join(f"select * from w{i}" for i in range(len(STORE_COLUMNS))))
def sheet_widths(spark, d):
    return report.column_widths(stores(spark, d)).select("column", F.col("width").cast("long").alias("width"))


@query("""select c_custkey, (case when c_custkey % 3 = 0 then 'Алтайский край' end) as region, n as city, 'ул. ' || c_custkey || ', 1' as address from (select c_custkey, lower(c_mktsegment) as n from customer)""")
def map_places(spark, d):
    """Region and city taken off the front of a map address."""
    x = customers(spark, d).select("c_custkey", F.lower("c_mktsegment").alias("n"))
    full = F.concat(F.when(F.col("c_custkey") % 3 == 0, "Алтайский край, ").otherwise(""), F.lit("г. "), F.col("n"), F.lit(", ул "), F.col("c_custkey"), F.lit(",, 1;"))
    y = x.select("c_custkey", places.split_region(full).alias("r"), full.alias("full"))
    y = y.select("c_custkey", places.clean_region(F.col("r.region")).alias("region"), F.lit(None).cast("string").alias("city"), F.coalesce("r.rest", "full").alias("address"))
    return places.city_and_address(y)


# --- pages, candidates and links, from templates over the tables ----------------------------------------------------


@query("""with a as (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) as l from pages), b as (select page_id, url, unnest(l) as href, unnest(range(len(l))) as pos from a)
select page_id, pos, href, case when regexp_matches(href, '^[a-z]+:') then href else regexp_extract(url, '^(https?://[^/?#]*)', 1) || href end as full_url from b""")
def page_links(spark, d):
    """P6 and what H1-H4 start from: every anchor in order, resolved."""
    a = html.anchors(html.parse_pages(table(spark, d, "pages"), fields=html.PAGE_LINKS), "page_id")
    return a.select("page_id", F.col("pos").cast("long").alias("pos"), "href", F.col("url").alias("full_url"))


@query("""with x as (select page_id as k, 'https://s.ru/c/' || page_id as u from pages)
select k as page_id, u || '?PAGEN_1=2' as page_url, 1 as pos from x union all select k, 'https://s.ru/c/page/' || k, 2 from x where k % 2 = 0 union all select k, u || '?a=1&page=3', 3 from x where k % 3 = 0""")
def page_pagination(spark, d):
    """H4: query and path forms, each once at its first place, never the page itself."""
    k, u = F.col("page_id"), F.concat(F.lit("https://s.ru/c/"), F.col("page_id"))
    link = lambda href: F.concat(F.lit('<a href="'), href, F.lit('">x</a>'))
    body = F.concat(link(u), link(F.lit("?PAGEN_1=2")), F.when(k % 2 == 0, link(F.concat(F.lit("/c/page/"), k))).otherwise(link(F.lit("/other"))), F.when(k % 3 == 0, link(F.lit("?a=1&amp;page=3"))).otherwise(link(F.lit("#page=9"))), link(F.lit("?PAGEN_1=2")))
    p = html.parse_pages(table(spark, d, "pages").select("page_id", u.alias("url"), body.alias("html")), fields=html.PAGE_LINKS).withColumn("__self", F.col("url"))
    return html.page_links(p, "page_id").select("page_id", "page_url", F.col("pos").cast("int").alias("pos"))


@query("""with recursive n as (select max(page_id) + 1 as n from pages),
links as (select page_id as k, [page_id, (page_id * 3 + 1) % n, (page_id * 7 + 2) % n]::bigint[] as links from pages, n where page_id % 5 > 0),
walk(start, queue, taken) as (select page_id, [page_id]::bigint[], 0 from pages union all
 select w.start, list_concat(w.queue, list_distinct_in_order)[1:20], w.taken + 1 from (
  select w.*, coalesce(list_filter(l.links, lambda x, i: not list_contains(w.queue, x) and list_position(l.links, x) = i), []::bigint[]) as list_distinct_in_order
  from walk w left join links l on l.k = w.queue[w.taken + 1] where w.taken < len(w.queue)) w),
whole as (select start, arg_max(queue, taken) as queue from walk group by 1)
select start as page_id, array_to_string(queue, ',') as queue from whole""")
def page_queues(spark, d):
    """Pagination in a queue's order, at most 20 pages a start, cycles and links to the page itself among them."""
    from ..sources import crawl

    p = table(spark, d, "pages").select("page_id")
    n = p.agg((F.max("page_id") + 1).alias("n"))
    k, as_text = F.col("page_id"), lambda c: c.cast("string")
    links = p.crossJoin(F.broadcast(n)).where(k % 5 > 0).select(as_text(k).alias("url"), F.array(as_text(k), as_text((k * 3 + 1) % F.col("n")), as_text((k * 7 + 2) % F.col("n"))).alias("links"))
    q = crawl.queues(p.select(as_text(k).alias("start")), links, 20)
    return q.select(F.col("start").cast("long").alias("page_id"), F.array_join("queue", ",").alias("queue"))


@query("""with x as (select page_id as k from pages)
select k as page_id, 'https://s.ru/r' || k || '/change' as region_url, 'Region ' || k as name from x union all select k, 'https://s.ru/b/CHANGE/', 'B' from x where k % 2 = 0""")
def region_links(spark, d):
    """First anchor of each change path; fragments and map paths are none."""
    k = F.col("page_id")
    body = F.concat(F.lit('<a href="/r'), k, F.lit('/change">Region '), k, F.lit('</a><a href="/r'), k, F.lit('/change">again</a><a href="/shops_map/x/change">m</a><a href="/change">c</a><a href="/r/change#f">f</a>'), F.when(k % 2 == 0, '<a href="/b/CHANGE/">B</a>').otherwise(""))
    p = html.parse_pages(table(spark, d, "pages").select("page_id", F.lit("https://s.ru/shops_map/").alias("url"), body.alias("html")), fields=html.REGION_LINKS)
    return html.region_links(p, "page_id")


@query("""select page_id, 'City ' || page_id as hint, 'https://s.ru/u/shops_map/c' || page_id as city_url, null::varchar as reason from pages
union all select page_id, 'Plus', 'https://s.ru/u/shops_map/+p', 'invalid_city_path' from pages where page_id % 2 = 0 union all select page_id, 'Number', 'https://s.ru/u/shops_map/12', 'invalid_city_path' from pages where page_id % 2 = 1
union all select page_id, 'Far', 'https://t.ru/u/shops_map/c', 'foreign_domain' from pages""")
def city_links(spark, d):
    """Anchors of the city list, accepted and refused; those outside the list don't count."""
    k = F.col("page_id")
    body = F.concat(F.lit('<a href="/u/shops_map/out">Out</a><ul class="x shop_city_list_ul"><li><a href="/u/Shops_Map/c'), F.lit('0"></a><li><a href="/u/shops_map/c'), k, F.lit('#f">City '), k, F.lit("</a>"), F.when(k % 2 == 0, '<li><a href="/u/shops_map/+p">Plus</a>').otherwise('<li><a href="/u/shops_map/12">Number</a>'), F.lit('<li><b><a href="https://t.ru/u/shops_map/c">Far</a></b></ul>'))
    p = html.parse_pages(table(spark, d, "pages").select("page_id", F.lit("https://s.ru/").alias("url"), body.alias("html")), fields=html.CITY_LINKS)
    return html.city_links(p, "s.ru", "page_id").where("hint <> ''").select("page_id", "hint", "city_url", "reason")


@query("""select page_id, 'https://s.ru/shops_map/e/' || page_id as store_url, 'ул. К, ' || page_id as address, case page_id % 3 when 0 then '08:00-21:00' when 1 then 'круглосуточно' end as work_time from pages""")
def store_summaries(spark, d):
    """Address of the anchor, hours of the lines around it that aren't the address."""
    k = F.col("page_id")
    hours = F.when(k % 3 == 0, "<div>с 8:00 — 21.00</div>").when(k % 3 == 1, "<div>Круглосуточно</div>").otherwise("<div>закрыто</div>")
    body = F.concat(F.lit('<div><p><a href="/shops_map/e/'), k, F.lit('">ул К, '), k, F.lit('</a></p>'), hours, F.lit('</div><a href="/shops_map/e/'), k, F.lit('">again</a><a href="/shops_map/e/">no</a>'))
    p = html.parse_pages(table(spark, d, "pages").select("page_id", F.lit("https://s.ru/c").alias("url"), body.alias("html")), fields=html.SUMMARIES)
    return html.store_summaries(p, "page_id").select("page_id", "store_url", "address", "work_time")


@query("""select s_suppkey, case s_suppkey % 4 when 0 then 'ул. ' || s_name when 1 then 'Мира, ' || s_suppkey when 2 then 'пер. ' || s_name end as address, case s_suppkey % 4 when 1 then '09:00-21:00' when 2 then '08:30-20:00' end as work_time,
case s_suppkey % 4 when 0 then '+7 ' || s_suppkey end as phone, case s_suppkey % 4 when 0 then 'Город К' when 3 then 'Омск' when 2 then 'Томск' end as city, case when s_suppkey % 4 = 3 then 'Край' end as store_format from supplier""")
def html_details(spark, d):
    """Pairs of dl and of detail blocks, labels in the text, script values; phones only from pairs."""
    k = F.col("s_suppkey")
    a = F.concat(F.lit("<dl><dt>Адрес</dt><dd>ул "), F.col("s_name"), F.lit("</dd><dt>Телефон</dt><dd>+7 "), k, F.lit("</dd><dt>Город</dt><dd>Город К</dd><dt>Без пары</dt></dl>"))
    b = F.concat(F.lit('<div class="wide contacts"><dt>Адрес магазина</dt><dd>Адрес: у Мира, '), k, F.lit("</dd><dt>Режим</dt><dd>9-21</dd></div><footer>тел: 8800</footer>"))
    c = F.concat(F.lit("<p>Адрес: пер "), F.col("s_name"), F.lit('</p><p>Время работы 8.30-20</p><script>{"city": "Томск"}</script>'))
    e = F.lit("<p>Формат магазина - Край</p><p>Город: Омск</p><p>Наш город: Тверь</p>")
    body = F.when(k % 4 == 0, a).when(k % 4 == 1, b).when(k % 4 == 2, c).otherwise(e)
    p = html.parse_pages(table(spark, d, "supplier").select("s_suppkey", F.lit("https://s.ru/").alias("url"), body.alias("html")), fields=html.STORE_PAGE)
    fields = html.store_page(F.col("page"))
    return p.select("s_suppkey", *[fields[c].alias(c) for c in ("address", "work_time", "phone", "city", "store_format")])


@query("""select s_suppkey, case when s_suppkey % 5 < 4 then s_suppkey % 80 + 0.25 end::double as latitude, case when s_suppkey % 5 < 4 then s_suppkey % 170 + 0.5 end::double as longitude from supplier""")
def html_geo(spark, d):
    """Attributes, meta properties, a script's pair in either order; half a pair is none."""
    k = F.col("s_suppkey")
    lat, lng = F.concat(k % 80, F.lit(".25")), F.concat(k % 170, F.lit(".5"))
    a = F.concat(F.lit('<i data-lat="x" data-lng="1"></i><i data-lat="'), F.replace(lat, F.lit("."), F.lit(",")), F.lit('" data-lon="'), lng, F.lit('"></i>'))
    b = F.concat(F.lit('<meta property="place:location:latitude" content="'), lat, F.lit('"><meta property="place:location:longitude" content="'), lng, F.lit('">'))
    c = F.concat(F.lit('<script>{"lat": "'), lat, F.lit('", "z": 1, "lng": '), lng, F.lit("}</script>"))
    e = F.concat(F.lit('<script>{"longitude": '), lng, F.lit(', "latitude": '), lat, F.lit("}</script>"))
    body = F.when(k % 5 == 0, a).when(k % 5 == 1, b).when(k % 5 == 2, c).when(k % 5 == 3, e).otherwise('<script>{"lat": 5.5}</script>')
    geo = html.coordinates(F.col("page"))
    return html.parse_pages(table(spark, d, "supplier").select("s_suppkey", F.lit("").alias("url"), body.alias("html")), fields=html.COORDINATES).select("s_suppkey", geo["lat"].alias("latitude"), geo["lng"].alias("longitude"))


@query("""select n_nationkey as city_id, n_name as city, case when n_nationkey % 4 = 0 then 'own ' || n_nationkey when n_regionkey = 4 then 'Регион #4' when n_regionkey > 0 then r_name end as region from nation left join region on n_regionkey = r_regionkey""")
def city_list(spark, d):
    """The first endpoint with cities; shops, repeats and what has no id aren't cities; region number 0 is none."""
    from ..sources import jsonsource as J

    n, r = table(spark, d, "nation"), table(spark, d, "region").where("r_regionkey <> 4")
    k = F.col("n_nationkey")
    own = F.struct(k.alias("id"), F.when(k % 2 == 0, F.col("n_name")).alias("name"), F.when(k % 2 == 1, F.col("n_name")).alias("cityName"), F.col("n_regionkey").alias("regionId"), F.when(k % 4 == 0, F.concat(F.lit("own "), k)).alias("regionName"))
    listed = n.agg(F.array_sort(F.collect_list(own)).alias("cities"))
    extra = '{"id": 1, "name": "twice"}, {"id": 900, "name": "s", "address": "x"}, {"name": "no id"}, 5'
    regions = r.agg(F.collect_list(F.struct(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("title"))).alias("regions"))
    body = F.concat(F.lit('{"data": {"cities": '), F.regexp_replace(F.to_json("cities"), "\\]$", f", {extra}]"), F.lit('}, "regions": '), F.to_json("regions"), F.lit("}"))
    one = listed.crossJoin(regions).select(F.explode(F.array(F.struct(F.lit(0).alias("rank"), F.lit('{"cities": []}').alias("body")), F.struct(F.lit(1).alias("rank"), body.alias("body")))).alias("x")).select("x.*")
    return J.cities(one).select("city_id", "city", "region")


@query("""select c_custkey, 0 as item, 'ул. ' || c_custkey as address, case when c_custkey % 4 < 2 then 'Омск' end as city, case c_custkey % 4 when 0 then '52,5' when 1 then '52.5' end as lat, case when c_custkey % 4 = 2 then '8' end as phone from customer""")
def candidate_flat(spark, d):
    """M1-M6: JSON.parse of a literal, a named list with loose JSON, a telling list, a named object; others give nothing."""
    from ..sources import mapscript

    k = F.col("c_custkey")
    a = F.concat(F.lit("var shops = [{'addr': 'ул. "), k, F.lit("', 'Town': ' Омск ', 'LAT': '52,5'},];"))
    b = F.concat(F.lit('f(JSON.parse("[{\\"address\\": \\"ул. '), k, F.lit('\\", \\"city\\": \\"Омск\\", \\"lat\\": 52.5}, 7]"))'))
    c = F.concat(F.lit('init([{"address": "ул. '), k, F.lit('", "tel": "8"}])'))
    e = F.concat(F.lit('mapData = {"points": [{"fullAddress": "ул. '), k, F.lit('"}]};'))
    s = customers(spark, d).select("c_custkey", F.when(k % 4 == 0, a).when(k % 4 == 1, b).when(k % 4 == 2, c).otherwise(e).alias("script"))
    return mapscript.candidates(s).select("c_custkey", "item", "address", "city", "lat", "phone")


@query("""select c_custkey, 'ул. ' || c_custkey as address, 'К' || c_custkey as city, case when c_custkey % 2 = 0 then '9-21' end as work_time, [85.5, 52.0]::double[] as coords from customer""")
def candidate_geojson(spark, d):
    """M5, M7: features with properties, and with the values in a popup."""
    from ..sources import mapscript

    k = F.col("c_custkey")
    geometry = F.lit('{"geometry": {"coordinates": [85.5, 52]}, "properties": {')
    flat = F.concat(F.lit('"address": "ул. '), k, F.lit('", "town": "К'), k, F.lit('", "schedule": "9-21"'))
    shown = F.concat(F.lit('"hintContent": "<b>Адрес: ул. '), k, F.lit('</b><br>Город - К'), k, F.lit('"'))
    s = customers(spark, d).select("c_custkey", F.concat(F.lit('[{"type": 1, "features": ['), geometry, F.when(k % 2 == 0, flat).otherwise(shown), F.lit("}}]}]")).alias("body"))
    s = s.select("c_custkey", F.regexp_extract("body", "(?s)^\\[\\{\"type\": 1, \"features\": (.*)\\}\\]$", 1).alias("script"))
    return mapscript.candidates(s, attribute=True).select("c_custkey", "address", "city", "work_time", "coords")


@query("""select c_custkey, 'ул. ' || c_custkey as address, case when c_custkey % 2 = 0 then '8-20' end as work_time, case when c_custkey % 3 = 0 then '8 800' end as phone, case when c_custkey % 2 = 1 then [85.25, 52.5]::double[] end as coords from customer""")
def candidate_popup(spark, d):
    """M5, M7-M9: upper-case items, and flat ones with an escaped popup."""
    from ..sources import mapscript

    k = F.col("c_custkey")
    phone = F.when(k % 3 == 0, "&lt;br&gt;Тел.: 8 800").otherwise("")
    popup = F.concat(F.lit('[{"popup": "Адрес магазина: ул. '), k, F.lit("&lt;br&gt;Режим работы: 8-20"), phone, F.lit('"}]'))
    upper = F.concat(F.lit('[{"NAME": " ", "addr": "ул. '), k, F.lit('", "COORDINATE": "52.5, 85.25", "STARTED_WORK": " "'), F.when(k % 3 == 0, ', "TEL": "8 800"').otherwise(""), F.lit("}]"))
    s = customers(spark, d).select("c_custkey", F.when(k % 2 == 0, popup).otherwise(upper).alias("script"))
    return mapscript.candidates(s, attribute=True).select("c_custkey", "address", "work_time", "phone", "coords")


@query("""with keys as (select c_custkey, c_custkey % 5 as k from customer),
items as (select c_custkey, unnest(range(4)) as item, k from keys)
select c_custkey, count(*) as stores, string_agg(distinct city, ',' order by city) as cities, min(address) as first_address from (
 select c_custkey, case when item = 3 and k > 0 then 'г. Омск' when item = 1 then 'г. Томск' when item = 3 then 'г. Бийск' else 'г. Омск' end as city,
  case when item = 1 then 'ул. Мира, 1' when item = 3 and k > 0 then 'пр. Новый, 2' when item = 3 then 'ул. Мира, 1' when item = 2 then 'ул. Мира, 2' else 'ул. Мира, 1' end as address from items
 where not (item = 2 and k = 1)) group by 1""")
def candidate_upper(spark, d):
    """Upper-case items without coordinates differ by what their NAME says; those alike in city, address and coordinates count once."""
    from ..sources import mapscript

    k = F.col("c_custkey") % 5
    one = lambda name, rest='"STARTED_WORK": "8", "END_WORK": "20"': '{"NAME": "' + name + '", ' + rest + "}"
    last = F.when(k > 0, one("г. Омск, пр. Новый, 2")).otherwise(one("г. Бийск, ул. Мира, 1"))
    third = F.when(k == 1, one("г. Омск, ул. Мира, 1", '"COORDINATE": "x"')).otherwise(one("г. Омск, ул. Мира, 2"))
    items = F.concat_ws(",", F.lit(one("г. Омск, ул. Мира, 1")), F.lit(one("г. Томск, ул. Мира, 1")), third, last)
    s = customers(spark, d).select("c_custkey", F.concat(F.lit("["), items, F.lit("]")).alias("script"))
    c = mapscript.candidates(s, attribute=True)
    once = dedup.keep_first(c, [F.col("c_custkey"), *dedup.candidate_keys()], [F.col("item")]).where("work_time = '8-20'")
    return once.groupBy("c_custkey").agg(F.count("*").alias("stores"), F.array_join(F.array_sort(F.collect_set("city")), ",").alias("cities"), F.min("address").alias("first_address"))


@query("""with x as (select c_custkey, c_custkey % 5 as k, 'ул. Мира, ' || c_custkey as a, 'https://shop.example/map#store=' as u from customer)
select c_custkey, 'map' as network, case k when 0 then 'Алтайский край' when 1 then 'Омская область' end as region, case k when 0 then 'Бийск' when 3 then 'Томск' else 'Омск' end as city, a as address,
 case k when 3 then '8:00-20:00' when 4 then '9-21' end as work_time, case when k <> 4 then 52.5::double end as latitude, case when k in (0, 1, 3) then 85.25::double end as longitude, case k when 3 then '8 800' end as phone,
 case k when 0 then 'мини маркет' end as store_format, case k when 1 then 'open' end as status, u || case when k in (0, 1, 3) then '52.500000,85.250000' else 'улмира' || c_custkey end as source_url from x""")
def map_store_rows(spark, d):
    """Candidates of five kinds to store rows; a flat pair counts only whole, else both come from the list; without a spot the address marks the url."""
    from ..sources import mapscript

    k = F.col("c_custkey")
    street = F.concat(F.lit("ул. Мира, "), k)
    item = lambda *parts: F.concat(F.lit("[{"), *[F.lit(x) if isinstance(x, str) else x for x in parts], F.lit("}]"))
    whole = item('"addr": "Алтайский край, г. Бийск, ', street, '", "lat": 52.5, "lon": "85,25", "storeFormat": " мини  маркет "')
    half = item('"address": "', street, '", "city": "Омск", "regionName": "Омская область", "LAT": "1", "coords": [85.25, 52.5], "status": "open"')
    alone = item('"address": "', street, '", "city": "Омск", "latitude": "52.5"')
    upper = item('"NAME": "г. Томск, ', street, '", "COORDINATE": "52.5, 85.25", "STARTED_WORK": " 8:00", "END_WORK": "20:00 ", "TEL": "8 800"')
    bare = item('"full_address": "', street, '", "locality": "Омск", "schedule": "9-21"')
    body = F.when(k % 5 == 0, whole).when(k % 5 == 1, half).when(k % 5 == 2, alone).when(k % 5 == 3, upper).otherwise(bare)
    c = mapscript.candidates(customers(spark, d).select("c_custkey", body.alias("script")), attribute=True)
    return mapscript.store_rows(c, network="map", map_url="https://shop.example/map", keep=("c_custkey",))


@query("""select c_custkey, case c_custkey % 7 when 0 then 'Омск, 5' when 1 then 'ул. ' || c_custkey when 2 then 'Омск, д. 5а' when 3 then 'Томск, ул. 1' when 4 then '5 этаж' when 6 then '5 к 2/3' end as address from customer""")
def address_city_strip(spark, d):
    """A city in front goes only where what follows says more than a house number."""
    k = F.col("c_custkey")
    a = F.when(k % 7 == 0, "Омск , 5").when(k % 7 == 1, F.concat(F.lit("ОМСК,, ул. "), k)).when(k % 7 == 2, "Омск, д. 5а").when(k % 7 == 3, "Томск, ул. 1").when(k % 7 == 4, "омск;,5  этаж").when(k % 7 == 6, "Омск, 5 к 2/3").otherwise(" n/a ")
    x = customers(spark, d).select("c_custkey", F.when(k % 7 == 4, F.replace(a, F.lit(";,"), F.lit(", "))).otherwise(a).alias("address"), F.lit("Омск").alias("city"))
    return text.address_pass(x, "address", "city").select("c_custkey", "address")


@query("""select event_id, event_id % 5 < 3 as gate from events""")
def age_gate(spark, d):
    """Marks in any case, with white space of any kind between words."""
    from ..sources import mapscript

    k = F.col("event_id") % 5
    body = F.when(k == 0, "<b>Вам\n  ЕСТЬ\t18?</b>").when(k == 1, '<div class="age-gate">').when(k == 2, "18+ Подтвердите").when(k == 3, "18+ магазин").otherwise("возраст")
    return table(spark, d, "events").select("event_id", mapscript.is_age_gate(body).alias("gate"))


@query("""with x as (select event_id, case event_id % 4 when 0 then 404 when 1 then 503 when 2 then 403 end as status, case when event_id % 3 = 0 then 'city/pagination page' else 'store page' end as scope from events)
select event_id, case when status is null or status >= 500 then 'ERROR' else 'WARNING' end as level, case when status = 404 and scope = 'city/pagination page' then 'WARNING' else 'INFO' end as quiet from x""")
def request_levels(spark, d):
    """Levels of failed requests, by status, scope and the default of the caller."""
    from ..sources import fetched

    k = F.col("event_id")
    x = table(spark, d, "events").select("event_id", F.when(k % 4 == 0, 404).when(k % 4 == 1, 503).when(k % 4 == 2, 403).alias("status"), F.when(k % 3 == 0, "city/pagination page").otherwise("store page").alias("scope"))
    return x.select("event_id", fetched.severity(F.col("status"), F.col("scope")).alias("level"), fetched.severity(F.col("status"), F.col("scope"), "INFO").alias("quiet"))


@query("""select n_nationkey, case n_nationkey % 5 when 0 then n_name when 1 then n_name || ' край' when 2 then null when 3 then null else n_name end as place, n_nationkey % 5 in (0, 4) as same from nation""")
def locations(spark, d):
    """L1, L2: names need two characters and a letter; equal by letters and digits."""
    k = F.col("n_nationkey") % 5
    raw = F.when(k == 0, F.concat(F.lit(" .:"), F.col("n_name"), F.lit(";- "))).when(k == 1, F.concat(F.col("n_name"), F.lit("  край"))).when(k == 2, " 12-34 ").when(k == 3, "я").otherwise(F.concat(F.col("n_name"), F.lit(" ")))
    return table(spark, d, "nation").select("n_nationkey", places.sanitize_location(raw).alias("place"), F.coalesce(places.same_location(raw, F.lower("n_name")), F.lit(False)).alias("same"))


@query("""select event_id, ['200', '201', '202'][(event_id % 3 + 1)::int] as city, event_id % 2 = 0 as kept from events""")
def shop_places(spark, d):
    """Names in order of precedence; kept: both coordinates read."""
    from ..sources import jsonsource as J

    k = F.col("event_id")
    name = F.when(k % 3 == 0, '"city": " ", "cityName": "200", "name": "x"').when(k % 3 == 1, '"town": "201", "title": "x"').otherwise('"city": 7, "locality": " 202 "')
    at = F.when(k % 2 == 0, '"latitude": "x", "lat": "1.5", "lon": 2').otherwise('"lat": [1], "lng": "2"')
    v = table(spark, d, "events").select("event_id", F.try_parse_json(F.concat(F.lit("{"), name, F.lit(", "), at, F.lit("}"))).alias("v"))
    v = v.select("event_id", J.first_text(F.col("v"), J.SHOP_CITY).alias("city"), J.number(F.col("v"), J.LATITUDE).alias("lat"), J.number(F.col("v"), J.LONGITUDE).alias("lng"))
    return v.select("event_id", "city", (F.col("lat").isNotNull() & F.col("lng").isNotNull()).alias("kept"))


@query("""select c_custkey, case c_custkey % 3 when 0 then 'Край ' || c_nationkey when 1 then 'Область' else n_name end as region, case when c_custkey % 2 = 0 then 'Омск' else n_name end as city,
 case when c_custkey % 5 > 0 then 'ул. ' || c_custkey end as address, case c_custkey % 3 when 0 then '9-21' when 1 then '8-20' end as work_time, case when c_custkey % 2 = 0 then 55.5::double end as latitude, 60::double as longitude,
 case when c_custkey % 4 = 0 then '8 800' end as phone, case when c_custkey % 3 = 2 then 'Мини' end as store_format, case when c_custkey % 2 = 0 then 'active' else 'inactive' end as status,
 'https://k.ru/api/cities/' || c_nationkey || '/shops/' || case when c_custkey % 7 > 0 then '#' || c_custkey else '' end as source_url from customer join nation on c_nationkey = n_nationkey""")
def shop_api_rows(spark, d):
    """Bodies of an API to store rows; a shop's own place comes before its city's, what isn't an object is no shop."""
    from ..sources import jsonsource as J

    k, q = F.col("c_custkey"), lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    region = F.when(k % 3 == 0, F.concat(F.lit('"region": {"name": '), q(F.concat(F.lit(" Край "), F.col("c_nationkey").cast("string"))), F.lit("}"))).when(k % 3 == 1, '"regionName": "Область", "region": {"name": "x"}').otherwise('"regionName": " "')
    place = F.when(k % 2 == 0, '"city": "Омск", "latitude": "55.5"').otherwise('"city": null, "lat": "x"')
    street = F.when(k % 5 > 0, F.concat(F.lit('"address": '), q(F.concat(F.lit(" ул. "), k)))).otherwise('"address": 5')
    hours = F.when(k % 3 == 0, '"workTime": {"daily": "9-21"}').when(k % 3 == 1, '"workTime": "", "work_time": {"week": ["8", "20"]}').otherwise('"workTime": [" "], "format": "Мини"')
    call = F.when(k % 4 == 0, '"phones": [" ", "8 800"]').when(k % 4 == 1, '"phone": "", "phones": ["1"]').otherwise('"phones": []')
    more = F.concat(F.lit('"lng": 60, "isActive": '), F.when(k % 2 == 0, "true").otherwise("false"), F.when(k % 7 > 0, F.concat(F.lit(', "id": '), k)).otherwise(', "id": 0'))
    body = F.concat(F.lit('{"items": [3, {'), F.concat_ws(", ", region, place, street, hours, call, more), F.lit("}]}"))
    c, n = customers(spark, d), table(spark, d, "nation")
    bodies = c.select(F.col("c_nationkey").alias("city_id"), body.alias("body"), "c_custkey")
    found = J.shops(bodies.select(F.struct("city_id", "c_custkey").alias("city_id"), "body")).select(F.col("city_id.city_id").alias("city_id"), (F.col("city_id.c_custkey") * 10 + F.col("pos")).alias("pos"), "shop")
    cities = n.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("n_name").alias("region"), F.lit(0).alias("pos"))
    rows = J.shop_rows(found, cities, network="K", base_url="https://k.ru")
    return rows.select(F.floor(F.col("pos") / 10).alias("c_custkey"), "region", "city", "address", "work_time", "latitude", "longitude", "phone", "store_format", "status", "source_url")


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return dict(_SQL)
