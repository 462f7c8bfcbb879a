"""Links of a site with regions, cities and stores in its paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_path(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")


def url_site(c: Column) -> Column:
    """Host and port, as written."""
    return F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def without_fragment(c: Column) -> Column:
    """P5."""
    return F.regexp_replace(c, r"#.*$", "")


def segments(c: Column) -> Column:
    return F.filter(F.split(url_path(c), "/"), lambda x: x != "")


def is_region_change(c: Column) -> Column:
    """P1."""
    s = segments(c)
    return (F.size(s) >= 2) & (F.lower(F.element_at(s, -1)) == "change") & ~F.array_contains(s, "shops_map")


def is_store_path(c: Column, marker: str = "shops_map") -> Column:
    """P4."""
    return url_path(c).rlike(rf"/{marker}/[^/]+/[0-9]+/?$")


def is_city_path(c: Column, marker: str = "shops_map") -> Column:
    """P2. Three segments, the second the marker, the third neither +... nor a number."""
    s = segments(c)
    third = F.get(s, F.lit(2))
    return F.coalesce((F.size(s) == 3) & (F.lower(F.get(s, F.lit(1))) == marker) & ~third.startswith("+") & ~third.rlike("^[0-9]+$") & ~is_store_path(c, marker), F.lit(False))


def href_reject_reason(href: Column, resolved: Column, site: str, marker: str = "shops_map") -> Column:
    """P3. Why a city link is refused, by the first reason that holds; null: accepted. site: the host (and port) that links must have."""
    h = F.trim(F.coalesce(href, F.lit("")))
    return (
        F.when(h == "", "empty").when(h.startswith("+"), "starts_with_plus").when(h.startswith("#"), "starts_with_hash").when(F.lower(h).startswith("javascript:"), "javascript_link")
        .when(~resolved.rlike("(?i)^https?://"), "unsupported_scheme").when(url_site(resolved) != site, "foreign_domain").when(~is_city_path(resolved, marker), "invalid_city_path")
    )


def is_page_link(c: Column) -> Column:
    """H4. Pagination by query or path."""
    return F.lower(F.regexp_extract(c, r"\?([^#]*)", 1)).rlike("page=|pagen_") | F.lower(url_path(c)).contains("/page/")
