"""Cities, regions and addresses of map candidates and of crawled pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bare_token, let

# --- fixed values -------------------------------------------------------------------------------------------------
LOCALITY = r"(?iu)^(?:г\.?|город|пгт|пос\.?|поселок|п\.|рп|р\.\s*п\.?|с\.|село|д\.|д\.п\.?|деревня|ст\.?|ст-ца|станица)\s*\S"
REGION_STARTS = ["респ. ", "республика "]
REGION_PARTS = ["область", "обл.", "край", "автономный округ", " ао"]
#: What makes an address of a text besides a digit, in order.
ADDRESS_PATTERNS = [
    r"(?:^|[\s,])ул\.?(?:\s|$|[a-zа-яё])",
    r"\bулиц",
    r"(?:^|[\s,])пр-кт(?:\s|$|[a-zа-яё])",
    r"(?:^|[\s,])пр-т(?:\s|$|[a-zа-яё])",
    r"\bпросп(?:ект)?\b",
    r"(?:^|[\s,])пер\.?(?:\s|$|[a-zа-яё])",
    r"\bпереул",
    r"\bквартал\b",
    r"(?:^|[\s,])кв-л(?:\s|$|[a-zа-яё])",
    r"(?:^|[\s,])мкр\.?(?:\s|$|[a-zа-яё])",
    r"\bдом\b",
    r"(?:^|[\s,])д\.\s*\d",
    r"(?:^|[\s,])б-р(?:\s|$|[a-zа-яё])",
    r"(?:^|[\s,])бул\.?(?:\s|$|[a-zа-яё])",
    r"\bшоссе\b",
    r"\bтракт\b",
    r"\bпроезд\b",
    r"\bпр-д\b",
    r"\bнабереж",
    r"\bплощад",
    r"\bаллея\b",
]
TECHNICAL_REGIONS = ["selection_wines", "coffee_frame", "round_clock_services", "opening_soon"]
LABEL = r"(?iu)^адрес(?: магазина)?\s*[:\-]?\s*"
STREET_REWRITES = [("ул\\s+", "ул. "), ("пер\\s+", "пер. "), ("пр[- ]?кт\\s+", "пр-кт "), ("пр-т\\s*", "пр-т "), ("просп(?:ект)?\\s+", "просп. "), ("б[- ]?р\\s+", "б-р "), ("бул\\s+", "бул. "), ("мкр\\s+", "мкр. "), ("кв[- ]?л\\s+", "кв-л "), ("д\\s+", "д. ")]
PAGE_REWRITES = [(r"(?iu)^адрес\s*[:\-]?\s*", ""), (r"(?iu)^у\s+ул\.?\s*", "ул. "), (r"(?iu)^у\s+", ""), (r"(?iu)^ул\s+", "ул. "), (r"(?iu)^пер\s+", "пер. "), (r"(?iu)^пр[- ]?кт\s+", "пр-кт "), (r"(?iu)^просп\s+", "просп. "), (r"\s+,", ","), (r",\s*,+", ", "), (r"\s{2,}", " ")]
# ------------------------------------------------------------------------------------------------------------------

_ADDRESS = "(?U)" + "|".join([r"\d", *ADDRESS_PATTERNS])


def _blank_null(c: Column) -> Column:
    return let(c, lambda x: F.when(x != "", x))


def clean_text(c: Column) -> Column:
    """M12."""
    x = F.btrim(F.regexp_replace(c, r"(?U)\s+", " "), F.lit(" \t\r\n,;"))
    x = F.regexp_replace(F.regexp_replace(x, r"\.(?=[A-Za-zА-Яа-яЁё])", ". "), r" {2,}", " ")
    return _blank_null(F.btrim(F.regexp_replace(x, r"\)+\s*$", ""), F.lit(" ,;")))


def looks_like_address(c: Column) -> Column:
    """M13."""
    return F.coalesce(F.lower(c).rlike(_ADDRESS), F.lit(False))


def looks_like_locality(c: Column) -> Column:
    """M14."""
    return F.coalesce(clean_text(c).rlike(LOCALITY), F.lit(False))


def looks_like_region(c: Column) -> Column:
    """M15."""
    anywhere, at_start = "|".join(x.replace(".", "\\.") for x in REGION_PARTS), "|".join(x.replace(".", "\\.") for x in REGION_STARTS)
    return F.coalesce(F.lower(clean_text(c)).rlike(f"^(?:{at_start})|{anywhere}"), F.lit(False))


def informative(c: Column) -> Column:
    """M19."""
    return looks_like_address(c) & ~F.trim(c).rlike(r"(?iu)^\d+[а-яa-z]?$")


def split_region(c: Column) -> Column:
    """M17. (region, rest) where a leading part names a region, else nulls."""
    both = F.split(F.regexp_replace(clean_text(c), LABEL, ""), r"\s*[,;]\s*", 2)

    def parts(p: Column) -> Column:
        ok = (F.size(p) == 2) & looks_like_region(F.trim(p[0]))
        return F.struct(F.when(ok, F.trim(p[0])).alias("region"), F.when(ok, F.trim(F.get(p, F.lit(1)))).alias("rest"))

    return let(both, parts)


def split_city(c: Column) -> Column:
    """M16, M18. (city, address): a leading locality before a comma, else the shortest leading tokens that name one before an informative rest, else (null, all)."""

    def prefix(x: Column) -> Column:
        def parts(p: Column) -> Column:
            left, right = F.trim(p[0]), F.trim(F.get(p, F.lit(1)))
            ok = (F.size(p) == 2) & (right != "") & looks_like_locality(left) & ~informative(left)
            return F.when(ok, F.struct(left.alias("city"), right.alias("address")))

        return let(F.split(x, r"\s*[,;]\s*", 2), parts)

    def tokens(x: Column) -> Column:
        def cuts(t: Column) -> Column:
            at = F.when(F.size(t) > 2, F.sequence(F.lit(2), F.greatest(F.size(t) - 1, F.lit(2))))
            pairs = F.transform(at, lambda i: F.struct(F.array_join(F.slice(t, F.lit(1), i), " ").alias("city"), F.array_join(F.slice(t, i + 1, F.size(t)), " ").alias("address")))
            return F.get(F.filter(pairs, lambda s: looks_like_locality(s["city"]) & informative(s["address"])), F.lit(0))

        return let(F.split(x, " "), cuts)

    whole = lambda x: F.struct(F.lit(None).cast("string").alias("city"), x.alias("address"))
    return let(_blank_null(F.btrim(F.regexp_replace(c, r"(?U)\s+", " "), F.lit(" ,"))), lambda x: F.coalesce(prefix(x), tokens(x), whole(x)))


def clean_region(c: Column) -> Column:
    """M20."""
    bad = lambda x: F.lower(x).rlike("|".join(TECHNICAL_REGIONS)) | x.rlike(r"^[A-Z0-9_]{3,}$") | looks_like_address(x) | ~x.rlike("[А-Яа-яЁё]")
    return let(clean_text(c), lambda x: F.when(~bad(x), x))


def clean_city(c: Column) -> Column:
    """M21."""
    x = F.regexp_replace(clean_text(c), r"(?iu)^(?:г\.?|город)\s*", "")
    x = F.btrim(F.regexp_replace(x, r"[\s)]*\)\s*$", ""), F.lit(" ,;"))
    return let(x, lambda y: F.when((y != "") & (looks_like_locality(y) | ~looks_like_address(y)), y))


def clean_address(c: Column, city: Column | None = None) -> Column:
    """M22. city: a leading part that equals it goes."""
    x = F.regexp_replace(clean_text(c), LABEL, "")
    for pattern, to in ((r"\s*;\s*", ", "), (r"\s+,", ","), (r",\s*,+", ", "), (r",(?=\S)", ", ")):
        x = F.regexp_replace(x, pattern, to)
    if city is not None:

        def rest(p: Column) -> Column:
            left, right = F.trim(p[0]), F.trim(F.get(p, F.lit(1)))
            return F.when((F.size(p) == 2) & (city != "") & (right != "") & (bare_token(F.coalesce(clean_city(left), left)) == bare_token(city)), right)

        x = let(x, lambda y: F.coalesce(let(F.split(y, ",", 2), rest), y))
    for pattern, to in STREET_REWRITES:
        x = F.regexp_replace(x, rf"(?iu)^{pattern}", to)
    x = F.btrim(F.regexp_replace(x, r"\s{2,}", " "), F.lit(" ,;"))
    return let(x, lambda y: F.when(y.rlike("[А-Яа-яЁё0-9]"), y))


def city_and_address(df: DataFrame, city: str = "city", address: str = "address") -> DataFrame:
    """M23. Both columns resolved together, in stages: an address may hold the city and a city the address."""
    df = df.withColumns({"__c": clean_text(F.col(city)), "__a": clean_address(F.col(address))})
    df = df.withColumn("__s", F.when(F.col("__c").isNull() & F.col("__a").isNotNull(), split_city(F.col("__a"))))
    moved = F.coalesce(informative(F.col("__s.address")), F.lit(False))
    df = df.withColumns({"__keep": F.col("__s").isNotNull() & ~moved, "__c": F.coalesce("__c", "__s.city"), "__a": F.when(F.col("__s").isNotNull() & moved, F.col("__s.address")).otherwise(F.col("__a"))})
    df = df.withColumn("__s", split_city(F.col("__c")))
    split = F.coalesce(F.col("__s.city").isNotNull() & (F.col("__s.address") != "") & (F.col("__s.city") != F.col("__c")), F.lit(False))
    df = df.withColumns({"__c": F.when(split, F.col("__s.city")).otherwise(F.col("__c")), "__a": F.when(split, F.coalesce("__a", "__s.address")).otherwise(F.col("__a"))})
    p = F.split("__c", ",", 2)
    left, right = F.trim(p[0]), F.trim(F.get(p, F.lit(1)))
    cut = F.coalesce((left != "") & looks_like_address(right), F.lit(False))
    df = df.withColumns({"__c": F.when(cut, left).otherwise(F.col("__c")), "__a": F.when(cut, F.coalesce("__a", right)).otherwise(F.col("__a"))})
    df = df.withColumn("__c", clean_city(F.col("__c")))
    return df.withColumns({city: F.col("__c"), address: F.when(F.col("__keep"), clean_address(F.col("__a"))).otherwise(clean_address(F.col("__a"), F.col("__c")))}).drop("__c", "__a", "__s", "__keep")


def page_address(c: Column) -> Column:
    """A1. Address text of a crawled page."""
    x = F.btrim(F.regexp_replace(c, r"(?U)\s+", " "), F.lit(" ,;"))
    for pattern, to in PAGE_REWRITES:
        x = F.regexp_replace(x, pattern, to)
    return _blank_null(F.btrim(x, F.lit(" ,;")))


def sanitize_location(c: Column) -> Column:
    """L1. Two characters or more, one of them a letter."""
    x = F.btrim(F.regexp_replace(c, r"(?U)\s+", " "), F.lit(" ,.;:-"))
    return F.when((F.char_length(x) >= 2) & x.rlike(r"\p{L}"), x)


def same_location(a: Column, b: Column) -> Column:
    """L2."""
    x, y = bare_token(a), bare_token(b)
    return (x != "") & (x == y)
