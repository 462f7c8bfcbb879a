"""Canonical rows and their identity key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ALIASES, STORE_COLUMNS
from .text import address_pass, coordinate, optional_text, source_url, text_token

# --- fixed value: urls of one chain whose last number names the store ---------------------------------------------
STORE_URL = r"(?i)https?://(?:www\.)?monetka\.ru/(?:[^/]+/)?shops_map/[^/]+/([0-9]+)/?$"
# ------------------------------------------------------------------------------------------------------------------


def compare_url(c: Column) -> Column:
    """K1. The cleaned url, or an alias where the url names a store of the chain with moving paths."""
    url = source_url(c)
    number = F.regexp_extract(url, STORE_URL, 1)
    return F.when(number != "", F.concat(F.lit("monetka-store:"), number)).otherwise(url)


def specific_url(c: Column) -> Column:
    """K2. Whether the url names one store."""
    return specific_alias(compare_url(c))


def specific_alias(x: Column) -> Column:
    """K2 of what compare_url gives."""
    return (x != "") & (x.startswith("monetka-store:") | x.contains("#") | x.rlike(r"/[0-9]+/?$") | x.rlike("(?i)(store|shop)="))


def pick(df: DataFrame, name: str) -> Column:
    """N7. The column, or the first of its older names that the input has; absent: null."""
    for n in (name, *ALIASES.get(name, ())):
        if n in df.columns:
            return F.col(n)
    return F.lit(None).cast("string")


def canonical(df: DataFrame, *, passes: int = 1, keep: tuple[str, ...] = (), collected_at: str | None = None) -> DataFrame:
    """N8, N9. The twelve canonical columns of any store-like rows, and those to keep.

    The address step repeats `passes` times: it strips one repeat of the city a pass, and how often
    it ran is a part of the result (build 1, output 2, snapshot 3).
    """
    cols = {n: coordinate(pick(df, n)) if n in ("latitude", "longitude") else optional_text(pick(df, n)) for n in STORE_COLUMNS if n != "address"}
    cols |= {"network": F.coalesce(cols["network"], F.lit("")), "source_url": source_url(pick(df, "source_url")), "address": pick(df, "address")}
    if collected_at is not None:
        cols["collected_at"] = F.coalesce(cols["collected_at"], F.lit(collected_at))
    out = df.select(*[F.col(k) for k in keep], *[cols[n].alias(n) for n in STORE_COLUMNS])
    for _ in range(passes):
        out = address_pass(out, "address", "city")
    return out


def stable_key(df: DataFrame, to: str = "stable_key") -> DataFrame:
    """K3. canonical rows plus the SHA-1 key of network, url, coordinates and, where the url isn't specific, location.

    The key reads the address after two more passes.
    """
    df = df.withColumns({"__a": F.col("address"), "__u": compare_url(F.col("source_url"))})
    for _ in range(2):
        df = address_pass(df, "__a", "city")
    labelled = lambda name, token: F.nullif(F.concat(F.lit(f"{name}:"), token), F.lit(f"{name}:"))
    url = F.col("__u")
    place = ~specific_alias(url)
    parts = [
        F.when(url != "", F.concat(F.lit("url:"), url)),
        F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.format_string("coords:%.6f,%.6f", "latitude", "longitude")),
        *[F.when(place, labelled(n, text_token(F.col(c)))) for n, c in (("region", "region"), ("city", "city"), ("address", "__a"))],
    ]
    rest = F.coalesce(F.nullif(F.concat_ws("||", *parts), F.lit("")), F.lit("fallback:unknown"))
    whole = F.concat_ws("||", F.concat(F.lit("network:"), text_token(F.col("network"))), rest)
    return df.withColumn(to, F.sha1(F.encode(whole, "UTF-8"))).drop("__a", "__u")
