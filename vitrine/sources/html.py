"""HTML pages: one Arrow pass over the standard library's parser; everything after it is native.

parse_pages() adds a struct of the fields asked for: text lines, anchors (those of stores with the lines of up to five
ancestors), definition pairs, coordinates in attributes, scripts, data attributes, headings. What isn't asked for is neither computed nor sent.
A page is walked once: every node knows which stretch of the page's texts is its own, so time grows with the page, not with its depth.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import links as L
from ..functions.places import page_address, same_location, sanitize_location
from ..functions.text import to_number_loose
from ..functions.worktime import clean_work_time, find_work_time

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# --- fixed values: where a page holds things ------------------------------------------------------------------------
DATA_LISTS = ["data-objects", "data-points", "data-shops", "data-stores", "data-features"]
DETAIL_CLASSES = {"shop-card", "store-card", "contacts", "content"}
STORE_PATH = re.compile(r"/shops_map/[^/]+/\d+/?$")
ANCESTORS = 5
# ------------------------------------------------------------------------------------------------------------------

class _Node:
    __slots__ = ("tag", "attrs", "parent", "children", "span")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children, self.span = tag, attrs, parent, [], (0, 0)

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def within(self, ok) -> bool:
        n = self.parent
        while n is not None:
            if ok(n):
                return True
            n = n.parent
        return False


def _walk(root: _Node) -> tuple[list[_Node], list[str]]:
    """Nodes and texts in document order; each node gets the span of its texts."""
    nodes, texts, stack = [], [], [root]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            if t := n.strip():
                texts.append(t)
        elif isinstance(n, tuple):  # the node's end
            n[0].span = (n[0].span[0], len(texts))
        else:
            nodes.append(n)
            n.span = (len(texts), len(texts))
            stack.append((n,))
            stack.extend(reversed(n.children))
    return nodes, texts


REFERENCE = re.compile(r"&(?!#)([A-Za-z][A-Za-z0-9]*;)?")


class _Tree(HTMLParser):
    """The tree of one page. A named reference counts only whole, with its semicolon: &amp at the end of a cut text stays as it stands."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)
        self.mark = None

    def feed(self, data):
        # the parser would resolve what is cut off, so those ampersands pass it as a character that the page doesn't have
        self.mark = next((c for c in map(chr, range(0xFDD0, 0xFDF0)) if c not in data), None)
        if self.mark is not None:
            data = REFERENCE.sub(lambda m: m[0] if m[1] in html5 else self.mark + m[0][1:], data)
        super().feed(data)

    def plain(self, s):
        return s.replace(self.mark, "&") if s and self.mark is not None else s or ""

    def node(self, tag, attrs):
        return _Node(self.plain(tag), {self.plain(k): self.plain(v) for k, v in reversed(attrs)}, self.at)

    def handle_starttag(self, tag, attrs):
        if self.at.tag in CLOSES.get(tag, ()):
            self.at = self.at.parent
        node = self.node(tag, attrs)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(self.node(tag, attrs))

    def handle_endtag(self, tag):
        tag, n = self.plain(tag), self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(self.plain(data))


class _Page:
    """A page's nodes and texts, and a method for each field. Any text is accepted; scripts count as text, as a plain text dump has them."""

    def __init__(self, html: str, base: str = ""):
        t = _Tree()
        t.feed(html)
        t.close()
        self.base = base
        self.nodes, self.texts = _walk(t.root)

    def inner(self, n: _Node) -> str:
        return " ".join(self.texts[n.span[0] : n.span[1]])

    def first(self, ok: Callable[[_Node], bool]) -> str | None:
        return next((self.inner(n) for n in self.nodes if ok(n)), None)

    def lines(self) -> list[str]:
        return [x for s in self.texts for x in s.splitlines()]

    def title(self) -> str | None:
        return self.first(lambda n: n.tag == "title")

    def h1(self) -> str | None:
        return self.first(lambda n: n.tag == "h1")

    def region_hint(self) -> str | None:
        return self.first(lambda n: n.tag == "span" and {"black", "dashed"} <= set(n.classes()))

    def active_region(self) -> list[str]:
        layer = lambda n: n.attrs.get("id") == "city_layer"
        chosen = lambda n: n.tag == "li" and "act" in n.classes() and n.within(layer)
        found = [self.first(lambda n, x=x: n.tag == x and n.within(chosen)) for x in ("span", "a")]
        found.append(self.first(lambda n: n.tag == "option" and "selected" in n.attrs and n.within(lambda m: m.tag == "select")))
        return [x for x in found if x is not None]

    def scripts(self) -> list[str]:
        return [self.inner(n) for n in self.nodes if n.tag == "script"]

    def script_urls(self) -> list[str]:
        return [self.resolved(n.attrs["src"]) for n in self.nodes if n.tag == "script" and n.attrs.get("src")]

    def data(self) -> list[str]:
        return [n.attrs[k] for n in self.nodes for k in DATA_LISTS if (n.attrs.get(k) or "").strip()]

    @cached_property
    def links(self) -> list[_Node]:
        return [n for n in self.nodes if n.tag == "a" and "href" in n.attrs]

    @cached_property
    def listed(self) -> set[int]:
        """What lies in a list of cities."""
        found = set()
        for n in self.nodes:  # parents come before their children
            if n.tag == "ul" and "shop_city_list_ul" in n.classes() or n.parent is not None and id(n.parent) in found:
                found.add(id(n))
        return found

    def resolved(self, href: str) -> str:
        """The link by the page's url; as it stands, where either is no url."""
        try:
            return urljoin(self.base, href)
        except ValueError:
            return href

    def url(self, n: _Node) -> str:
        return self.resolved(n.attrs["href"].strip())

    def around(self, n: _Node) -> list[str]:
        try:
            store = STORE_PATH.search(urlsplit(self.url(n)).path) is not None
        except ValueError:
            store = False
        return _around(n, self.texts) if store else []

    def anchors(self, parts: Iterable[str]) -> Iterator[tuple]:
        """The asked parts of every anchor."""
        ways = {"href": lambda n: n.attrs["href"].strip(), "url": self.url, "text": self.inner, "in_city_list": lambda n: id(n) in self.listed, "around": self.around}
        return (tuple(ways[p](n) for p in parts) for n in self.links)

    def pairs(self, parts: Iterable[str]) -> Iterator[tuple]:
        """Labels and values, paired by place, of each block that holds any."""
        blocks = [n for n in self.nodes if n.tag == "dl" or DETAIL_CLASSES & set(n.classes())]  # in the order of the page
        owned: dict[int, dict[str, list[_Node]]] = {id(n): {"dt": [], "dd": []} for n in blocks}
        for x in self.nodes if blocks else ():
            n = x.parent if x.tag in ("dt", "dd") else None
            while n is not None:
                if id(n) in owned:
                    owned[id(n)][x.tag].append(x)
                n = n.parent
        for b, d in enumerate(blocks):
            for i, (k, v) in enumerate(zip(owned[id(d)]["dt"], owned[id(d)]["dd"], strict=False)):
                row = {"block": b, "pos": i, "label": self.inner(k), "value": self.inner(v)}
                yield tuple(row[p] for p in parts)

    def geo(self, parts: Iterable[str]) -> Iterator[tuple]:
        """Coordinates of attributes, then of meta properties."""
        found = []
        for n in self.nodes:
            found.append((n.attrs.get("data-lat") or n.attrs.get("data-latitude"), n.attrs.get("data-lng") or n.attrs.get("data-lon") or n.attrs.get("data-longitude")))
        for attr, *names in (("property", "place:location:latitude", "place:location:longitude"), ("itemprop", "latitude", "longitude")):
            found.append(tuple(next((n.attrs["content"] for n in self.nodes if n.attrs.get(attr) == x and n.attrs.get("content")), None) for x in names))
        return (tuple({"lat": lat, "lng": lng}[p] for p in parts) for lat, lng in found if lat and lng)


def _around(anchor: _Node, texts: list[str]) -> list[str]:
    """Lines of up to ANCESTORS ancestors, the nearest first; what a nearer one holds isn't said again."""
    a = b = anchor.span[0]
    out, n = [], anchor.parent
    for _ in range(ANCESTORS):
        if n is None or not n.tag:
            break
        for part in (texts[n.span[0] : a], texts[b : n.span[1]]):
            out += [x.strip() for s in part for x in s.splitlines() if x.strip()]
        (a, b), n = n.span, n.parent
    return out


KINDS = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
#: Fields of a page and their types; of lists of records, the types of their parts.
FIELDS: dict[str, str | dict[str, str]] = {
    "lines": "array<string>",
    "title": "string",
    "h1": "string",
    "region_hint": "string",
    "active_region": "array<string>",
    "scripts": "array<string>",
    "script_urls": "array<string>",
    "data": "array<string>",
    "anchors": {"href": "string", "url": "string", "text": "string", "in_city_list": "boolean", "around": "array<string>"},
    "pairs": {"block": "int", "pos": "int", "label": "string", "value": "string"},
    "geo": {"lat": "string", "lng": "string"},
}
# What the functions below need of a page.
REGION_LINKS = ("anchors.href", "anchors.url", "anchors.text")
CITY_LINKS = (*REGION_LINKS, "anchors.in_city_list")
SUMMARIES = ("anchors.url", "anchors.text", "anchors.around")
PAGE_LINKS = ("anchors.href", "anchors.url")
COORDINATES = ("scripts", "geo")
STORE_PAGE = ("lines", "pairs", *COORDINATES)
CITY_CONTEXT = ("h1", "region_hint")


def planned(asked: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """Fields in the order of FIELDS with the parts asked of each: "anchors" asks for all of them, "anchors.url" for one."""
    asked, plan = set(asked), {}
    for name, kind in FIELDS.items():
        parts = tuple(p for p in kind if {name, f"{name}.{p}"} & asked) if isinstance(kind, dict) else ()
        if parts or name in asked:
            plan[name] = parts
            asked -= {name, *(f"{name}.{p}" for p in parts)}
    if asked or not plan:
        raise ValueError(f"a page has no fields {sorted(asked)}; it has {list(FIELDS)}")
    return plan


def parse_pages(pages: DataFrame, html: str = "html", url: str = "url", fields: Iterable[str] = tuple(FIELDS)) -> DataFrame:
    """pages plus the struct `page` of the fields, or parts of fields ("anchors.url"), asked for. A null page has no texts."""
    plan = planned(fields)
    record = lambda n, ps: f"{n}:array<struct<{','.join(f'{p}:{FIELDS[n][p]}' for p in ps)}>>"
    kind = "struct<" + ",".join(record(n, ps) if ps else f"{n}:{FIELDS[n]}" for n, ps in plan.items()) + ">"

    def columns(texts: pa.Array, bases: pa.Array) -> pa.Array:
        held: dict[str, list] = {n: [] for n in plan}
        for text, base in zip(texts.to_pylist(), bases.to_pylist(), strict=True):
            page = _Page(text, base)
            for n, parts in plan.items():
                held[n].append(list(getattr(page, n)(parts)) if parts else getattr(page, n)())
        return pa.StructArray.from_arrays([_records(held[n], FIELDS[n], ps) if ps else pa.array(held[n], KINDS[FIELDS[n]]) for n, ps in plan.items()], list(plan))

    return pages.withColumn("page", F.arrow_udf(columns, kind)(F.coalesce(F.col(html), F.lit("")), F.coalesce(F.col(url), F.lit(""))))


def _records(rows: list[list[tuple]], kinds: dict[str, str], parts: tuple[str, ...]) -> pa.Array:
    """A list column of structs, a column a part, without a dictionary a record."""
    ends = [0]
    for r in rows:
        ends.append(ends[-1] + len(r))
    flat = [x for r in rows for x in r]
    cells = [pa.array([x[i] for x in flat], KINDS[kinds[p]]) for i, p in enumerate(parts)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(cells, list(parts)))


def anchors(parsed: DataFrame, *keep: str) -> DataFrame:
    return parsed.select(*keep, F.posexplode("page.anchors").alias("pos", "a")).select(*keep, "pos", "a.*")


def region_links(parsed: DataFrame, *keep: str) -> DataFrame:
    """H1. First anchor of each region url of a page."""
    a = anchors(parsed, *keep)
    a = a.where((F.col("href") != "") & ~F.col("url").rlike("#.") & L.is_region_change(F.col("url")))
    return a.groupBy(*keep, L.without_fragment(F.col("url")).alias("region_url")).agg(F.min(F.struct("pos", "text")).alias("f")).select(*keep, "region_url", F.col("f.text").alias("name"))


def city_links(parsed: DataFrame, host: str, *keep: str) -> DataFrame:
    """H2. Anchors of city lists with the reason for which they are refused (null: accepted) and the hint."""
    a = anchors(parsed, *keep).where("in_city_list")
    return a.select(*keep, "pos", "href", L.without_fragment(F.col("url")).alias("city_url"), F.col("text").alias("hint"), L.href_reject_reason(F.col("href"), F.col("url"), host).alias("reason"))


def store_summaries(parsed: DataFrame, *keep: str) -> DataFrame:
    """H3. (store_url, address, work_time): the first anchor of each store url; hours from lines around it that aren't the address."""
    a = anchors(parsed, *keep).where(L.is_store_path(F.col("url"))).withColumn("address", page_address(F.col("text")))
    a = a.groupBy(*keep, F.col("url").alias("store_url")).agg(F.min(F.struct("pos", "address", "around")).alias("f")).select(*keep, "store_url", "f.pos", "f.address", "f.around")
    hours = F.filter(F.transform("around", lambda x: F.when(~F.coalesce(same_location(x, F.col("address")), F.lit(False)), find_work_time(x))), lambda x: x.isNotNull())
    return a.select(*keep, "store_url", "pos", "address", F.get(hours, F.lit(0)).alias("work_time"))


def page_links(parsed: DataFrame, *keep: str) -> DataFrame:
    """H4. Pagination links other than the page itself, each with its first place."""
    found = anchors(parsed, *keep, "__self").where((F.col("href") != "") & L.is_page_link(F.col("url")) & (F.col("url") != F.col("__self")))
    return found.groupBy(*keep, F.col("url").alias("page_url")).agg(F.min("pos").alias("pos"))


# --- fixed values: labels of a store page, in order of precedence ---------------------------------------------------
ADDRESS_LABELS, HOURS_LABELS, FORMAT_LABELS, STATUS_LABELS = ["Адрес", "Почтовый адрес"], ["Режим работы", "Время работы"], ["Формат магазина"], ["Статус"]
CITY_LABELS, REGION_LABELS = ["Город", "Населенный пункт"], ["Регион", "Область", "Край", "Республика"]
PAIR_FIELDS = [("address", ["адрес"]), ("work_time", ["режим", "время"]), ("store_format", ["формат"]), ("status", ["статус", "status"]), ("phone", ["тел"]), ("city", ["город", "населен", "city", "locality"]), ("region", ["регион", "област", "край", "region"])]
# ------------------------------------------------------------------------------------------------------------------


def label_value(text: Column, labels: list[str], *, strict: bool = False) -> Column:
    """H8, H9. What follows the first label that has a value on its line; strict: only at a line's start with : or -."""
    form = r"(?iud)(?:^|\n)\s*{}\s*[:\-]\s*([^\n]+)" if strict else r"(?iud){}\s*[:\-]?\s*([^\n]+)"
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(text, form.format(x), 1)), F.lit("")) for x in labels])


def pair_value(pairs: Column, field: str) -> Column:
    """H7. The last value whose label falls to the field; a label falls to the first field that claims it."""
    before = []
    for name, marks in PAIR_FIELDS:
        if name == field:
            break
        before += marks
    mine = "|".join(dict(PAIR_FIELDS)[field])
    ok = lambda p: F.lower(p["label"]).rlike(mine) & (~F.lower(p["label"]).rlike("|".join(before)) if before else F.lit(True)) & (F.trim(p["value"]) != "")
    return F.try_element_at(F.filter(pairs, ok), F.lit(-1))["value"]


def coordinates(page: Column) -> Column:
    """H11. (lat, lng) as a pair: attributes, then a pair in the scripts in either order."""
    script = F.array_join(page["scripts"], " ")
    lat, lng = r'"lat(?:itude)?"\s*:\s*"?([0-9]{1,2}\.\d+)"?', r'"(?:lng|lon|longitude)"\s*:\s*"?([0-9]{1,3}\.\d+)"?'
    pair = lambda a, b: F.struct(to_number_loose(a).alias("lat"), to_number_loose(b).alias("lng"))
    found = F.concat(F.transform(page["geo"], lambda g: pair(g["lat"], g["lng"])), F.array(pair(F.regexp_extract(script, rf"(?i){lat}.{{0,120}}?{lng}", 1), F.regexp_extract(script, rf"(?i){lat}.{{0,120}}?{lng}", 2)), pair(F.regexp_extract(script, rf"(?i){lng}.{{0,120}}?{lat}", 2), F.regexp_extract(script, rf"(?i){lng}.{{0,120}}?{lat}", 1))))
    return F.get(F.filter(found, lambda p: p["lat"].isNotNull() & p["lng"].isNotNull()), F.lit(0))


def store_page(page: Column) -> dict[str, Column]:
    """H10-H13. Fields of a store's own page; phones only from its details, never from the page at large."""
    text, pairs, script = F.array_join(page["lines"], "\n"), page["pairs"], F.array_join(page["scripts"], " ")
    structured = lambda k: F.nullif(F.trim(F.regexp_extract(script, rf'(?i)"{k}"\s*:\s*"([^"]+)"', 1)), F.lit(""))
    geo = coordinates(page)
    return {
        "address": page_address(F.coalesce(pair_value(pairs, "address"), label_value(text, ADDRESS_LABELS))),
        "work_time": clean_work_time(F.coalesce(pair_value(pairs, "work_time"), label_value(text, HOURS_LABELS))),
        "store_format": F.coalesce(pair_value(pairs, "store_format"), label_value(text, FORMAT_LABELS)),
        "status": F.coalesce(pair_value(pairs, "status"), label_value(text, STATUS_LABELS)),
        "phone": pair_value(pairs, "phone"),
        "city": sanitize_location(F.coalesce(pair_value(pairs, "city"), label_value(text, CITY_LABELS, strict=True), structured("city"))),
        "region": sanitize_location(F.coalesce(pair_value(pairs, "region"), label_value(text, REGION_LABELS, strict=True), structured("region"))),
        "latitude": geo["lat"],
        "longitude": geo["lng"],
    }


def active_region(page: Column) -> Column:
    """H5. The first of the marked places whose text is a name."""
    return F.get(F.filter(F.transform(page["active_region"], sanitize_location), lambda x: x.isNotNull()), F.lit(0))


def city_context(page: Column, hint: Column) -> Column:
    """H6. (city, region) of a city page: the link's hint, else the heading; the region's marked span."""
    head = sanitize_location(F.nullif(F.regexp_extract(page["h1"], r"(?iu)Карта\s+магазинов\s+в\s+(.+)$", 1), F.lit("")))
    return F.struct(F.coalesce(sanitize_location(hint), head).alias("city"), sanitize_location(page["region_hint"]).alias("region"))


def popup_lines(html: str) -> str:
    t = _Tree()
    t.feed(unescape(html or ""))
    t.close()
    return "\n".join(_walk(t.root)[1])
