"""Store candidates of a map page: lists in scripts, data attributes and popups.

JavaScript literals need Python: one Arrow pass turns a script into candidates; cleaning is native.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator
from html import unescape
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import places as P
from ..functions.text import bare_token, to_number_comma
from ..operators.dedup import candidate_keys, keep_first
from .html import popup_lines

# --- fixed values -------------------------------------------------------------------------------------------------
LIST_NAMES = ["shops", "stores", "points", "markers", "features"]
OBJECT_NAMES = ["objects", "shopsData", "storesData", "mapData"]
INNER_LISTS = ["features", "objects", "shops", "stores", "points", "data"]
TELLING = ["address", "lat", "lng", "coords", "balloonContent"]
FIELDS = {"address": ["address", "addr", "full_address", "fullAddress"], "city": ["city", "town", "locality", "settlement"], "region": ["region", "region_name", "regionName"], "work_time": ["work_time", "schedule", "workTime"], "phone": ["phone", "tel", "telephone"], "status": ["status", "status_name", "statusName"], "format": ["format", "store_format", "storeFormat"]}
UPPER = {"address": ["ADDRESS", "ADDR", "FULL_ADDRESS", "FULLADDRESS"], "city": ["CITY", "TOWN", "LOCALITY", "SETTLEMENT"], "region": ["REGION", "REGION_NAME", "REGIONNAME", "SECTION"], "work_time": ["WORK_TIME", "SCHEDULE", "WORKTIME"], "phone": ["PHONE", "TEL", "TELEPHONE"], "status": ["STATUS", "STATUS_NAME", "STATUSNAME"], "format": ["FORMAT", "STORE_FORMAT", "STOREFORMAT"]}
LATITUDE, LONGITUDE, COORDINATES = ["lat", "latitude"], ["lng", "lon", "longitude"], ["coords", "coordinates"]
POPUPS, FEATURE_POPUPS = ["popup", "balloonContent", "balloonContentBody"], ["balloonContent", "balloonContentBody", "hintContent"]
POPUP_LABELS = {"address": r"(?:Адрес(?: магазина)?|Магазин)", "work_time": r"(?:Режим работы|Время работы)", "phone": r"(?:Телефон|Тел\.)", "city": r"(?:Город|Населенный пункт|Населённый пункт)", "region": r"(?:Регион|Область|Край|Республика)", "format": r"Формат(?: магазина)?", "status": r"Статус"}
GATE_MARKS = ["age-gate", "age_gate", "вам есть 18", "мне есть 18", "подтвердите возраст", "подтверждение возраста"]
# ------------------------------------------------------------------------------------------------------------------

CANDIDATE = "address string, city string, region string, work_time string, phone string, lat string, lng string, coords array<double>, status string, format string, name string, upper boolean"
_COLUMNS = ["address", "city", "region", "work_time", "phone", "lat", "lng", "coords", "status", "format", "name", "upper"]


def is_age_gate(c: Column) -> Column:
    """P9."""
    x = F.regexp_replace(F.lower(c), r"(?U)\s+", " ")
    return x.rlike("|".join(GATE_MARKS)) | (x.contains("18+") & x.rlike("подтверд|возраст"))


def lenient_json(text: str):
    """M3. JSON with a trailing ; or commas, single quotes and escaped slashes; anything else is None."""
    s = re.sub(r",(\s*[}\]])", r"\1", text.strip().rstrip(";")).replace("'", '"').replace("\\/", "/")
    try:
        return json.loads(s)
    except ValueError:
        return None


def string_literal(token: str) -> str | None:
    """M2."""
    import warnings

    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            value = ast.literal_eval(token)
    except (ValueError, SyntaxError, MemoryError):
        return None
    return value if isinstance(value, str) else None


def lookup(d: dict, names: list[str]):
    """M6. The value under the first name that is there, as spelled, then in any case."""
    for n in names:
        if n in d:
            return d[n]
    low = {k.lower(): v for k, v in d.items()}
    return next((low[n.lower()] for n in names if n.lower() in low), None)


def _text(d: dict, names: list[str]) -> str | None:
    v = lookup(d, names)
    return v.strip() or None if isinstance(v, str) else None


def popup(html: str | None) -> dict:
    """M7. Labelled values of a popup's text lines."""
    text = popup_lines(html) if html else ""
    found = {k: re.search(rf"{p}\s*[:\-]?\s*(.+)", text, re.IGNORECASE) for k, p in POPUP_LABELS.items()}
    return {k: v for k, m in found.items() if m and (v := m[1].strip())}


def _numbers(v) -> list[float] | None:
    try:
        return [float(x) for x in v][:2] if isinstance(v, list) and len(v) >= 2 else None
    except (TypeError, ValueError):
        return None


def pair_of(text) -> list[float] | None:
    """M8. "lat,lng" as [lng, lat]."""
    try:
        lat, lng = (float(x) for x in text.split(","))
    except (AttributeError, ValueError):
        return None
    return [lng, lat]


def candidate(raw: dict) -> dict | None:
    """M5. One candidate from an object of one of three shapes; None where a flat one says nothing."""
    out = dict.fromkeys(_COLUMNS)
    if any(k in raw for k in ("NAME", "COORDINATE", "STARTED_WORK", "END_WORK")):
        out |= {k: _text(raw, names) for k, names in UPPER.items()} | {"name": _text(raw, ["NAME", "name"]), "coords": pair_of(lookup(raw, ["COORDINATE", "coordinate"])), "upper": True}
        a, b = raw.get("STARTED_WORK"), raw.get("END_WORK")
        if isinstance(a, str) and isinstance(b, str) and a.strip() and b.strip():  # M9
            out["work_time"] = f"{a.strip()}-{b.strip()}"
        return out
    inside = [raw.get(k) if isinstance(raw.get(k), dict) else None for k in ("geometry", "properties")]
    if any(x is not None for x in inside):
        geometry, source = (x or {} for x in inside)
        shown = next((source[k] for k in FEATURE_POPUPS if source.get(k)), None)
        out["coords"] = _numbers(geometry.get("coordinates"))
    else:
        source, shown = raw, _text(raw, POPUPS)
        lat, lng = lookup(raw, LATITUDE), lookup(raw, LONGITUDE)
        out |= {"lat": None if lat is None else str(lat), "lng": None if lng is None else str(lng), "coords": _numbers(lookup(raw, COORDINATES))}
    said = popup(shown if isinstance(shown, str) else None)
    out |= {k: _text(source, names) or said.get(k) for k, names in FIELDS.items()}
    if source is raw and all(out[k] is None for k in ("address", "coords", "lat", "city", "work_time")):
        return None
    return out


def candidates_of(value) -> list[dict]:
    """M4."""
    return [c for x in value if isinstance(x, dict) and (c := candidate(x))] if isinstance(value, list) else []


OPEN_CALL, CLOSE_CALL = re.compile(r"""JSON\.parse\(\s*(["'])"""), re.compile(r"\s*\)")
OPEN_LIST, CLOSE_LIST = re.compile(rf"(?:{'|'.join(LIST_NAMES)})\s*[:=]\s*\[", re.IGNORECASE), re.compile(r"\]\s*[;,}]")
OPEN_OBJECT, CLOSE_OBJECT = re.compile(rf"(?:{'|'.join(OBJECT_NAMES)})\s*[:=]\s*\{{", re.IGNORECASE), re.compile(r"\}\s*[;,]")
TELLING_MARK, FEATURES_MARK = re.compile(f'"(?:{"|".join(TELLING)})"', re.IGNORECASE), re.compile(r'"features"\s*:\s*\[')
PLAIN = {q: re.compile(rf"[^\\{q}]*") for q in "\"'"}

# Literals of a script, each found by moving forward only: the time is in proportion to the script, however many brackets open in it.


def literal_end(script: str, start: int, quote: str) -> int:
    """Where a string literal ends that a call's parenthesis follows; -1: nowhere.

    A backslash takes the next character with it; where no end follows from that, it stands for itself. No place is looked at twice.
    """
    seen, open_places = set(), [start]
    while open_places:
        at = open_places.pop()
        if at in seen:
            continue
        seen.add(at)
        at = PLAIN[quote].match(script, at).end()
        if at == len(script):
            continue
        if script[at] == quote:
            if CLOSE_CALL.match(script, at + 1):
                return at
            continue
        open_places.append(at + 1)
        if script[at + 1 : at + 2] not in ("", "\n"):
            open_places.append(at + 2)
    return -1


def json_calls(script: str) -> Iterator[str]:
    """String literals that JSON.parse is called with."""
    at = 0
    while m := OPEN_CALL.search(script, at):
        end = literal_end(script, m.end(), m[1])
        at = m.end()
        if end >= 0:
            yield script[m.end() - 1 : end + 1]
            at = CLOSE_CALL.match(script, end + 1).end()


def enclosed(script: str, opening: re.Pattern, closing: re.Pattern) -> Iterator[str]:
    """From the bracket that ends an opening to the first bracket that begins a closing."""
    at = 0
    while (m := opening.search(script, at)) and (c := closing.search(script, m.end())):
        yield script[m.end() - 1 : c.start() + 1]
        at = c.end()


def telling_lists(script: str) -> Iterator[str]:
    """From a bracket to the first one that closes after a telling name."""
    at = 0
    while (i := script.find("[", at)) >= 0 and (m := TELLING_MARK.search(script, i + 1)) and (e := script.find("]", m.end())) >= 0:
        yield script[i : e + 1]
        at = e + 1


def collections(script: str) -> Iterator[str]:
    """From a brace over a list of features to the first brace that closes after it."""
    at = 0
    while (i := script.find("{", at)) >= 0 and (m := FEATURES_MARK.search(script, i + 1)) and (e := script.find("]", m.end())) >= 0 and (b := script.find("}", e + 1)) >= 0:
        yield script[i : b + 1]
        at = b + 1


def script_candidates(script: str) -> list[dict]:
    """M1. The first strategy that yields any: JSON.parse calls, named and telling arrays, named objects, feature collections."""
    def parsed():
        for x in json_calls(script):
            yield lenient_json(string_literal(x) or "")
        for x in chain(enclosed(script, OPEN_LIST, CLOSE_LIST), telling_lists(script)):
            yield lenient_json(x)
        for x in enclosed(script, OPEN_OBJECT, CLOSE_OBJECT):
            d = lenient_json(x)
            yield from ((d.get(k) for k in INNER_LISTS) if isinstance(d, dict) else ())
        for x in collections(script):
            d = lenient_json(x)
            yield d.get("features") if isinstance(d, dict) else None

    return next((c for v in parsed() if (c := candidates_of(v))), [])


def _scripts(s: pd.Series) -> pd.Series:
    return s.map(lambda x: script_candidates(x or ""))


def _lists(s: pd.Series) -> pd.Series:
    return s.map(lambda x: candidates_of(lenient_json(unescape(x or ""))))


def candidates(texts: DataFrame, text: str = "script", *, attribute: bool = False) -> DataFrame:
    """S8-S10. texts plus one row for each candidate, with its place `item` in the list.

    The NAME of an upper-case item is split here, so that what follows, D4 first, sees its city and address.
    """
    kind = "array<struct<" + ", ".join(f"{x.split()[0]}:{x.split(' ', 1)[1]}" for x in CANDIDATE.split(", ")) + ">>"
    found = F.pandas_udf(_lists if attribute else _scripts, kind)(F.col(text))
    df = texts.withColumn("__c", found).select(*texts.columns, F.posexplode("__c").alias("item", "__c")).select(*texts.columns, "item", "__c.*")
    df = df.withColumn("__named", F.when(F.col("upper"), P.split_city(F.col("name"))))  # a column, so that it is split once
    named = F.col("__named")
    return df.withColumns({"address": F.coalesce(F.nullif(named["address"], F.lit("")), "address"), "city": F.coalesce(named["city"], "city")}).drop("__named")


def dedup_candidates(df: DataFrame, order: list[str]) -> DataFrame:
    """D4."""
    return keep_first(df, candidate_keys(), [F.col(c) for c in order])


def store_rows(df: DataFrame, *, network: str, map_url: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """M26. Store-like rows of candidates."""
    r = P.split_region(F.col("address"))
    df = df.withColumns({"__r": r}).withColumns({"region": F.coalesce(P.clean_region(F.col("region")), P.clean_region(F.col("__r.region"))), "address": F.coalesce(F.nullif("__r.rest", F.lit("")), "address")})
    df = P.city_and_address(df)
    flipped = F.col("lat").isNull() | F.col("lng").isNull()  # M10: then both come from the pair
    pick = lambda flat, i: F.when(flipped & (F.size("coords") >= 2), F.get("coords", F.lit(i))).otherwise(to_number_comma(F.col(flat)))
    df = df.withColumns({"latitude": pick("lat", 1), "longitude": pick("lng", 0)})
    token = bare_token(F.col("address"))
    spot = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.format_string("#store=%.6f,%.6f", "latitude", "longitude")).when(token != "", F.concat(F.lit("#store="), token)).otherwise("")
    return df.select(*keep, F.lit(network).alias("network"), "region", "city", "address", "work_time", "latitude", "longitude", "phone", P.clean_text(F.col("format")).alias("store_format"), P.clean_text(F.col("status")).alias("status"), F.concat(F.lit(map_url), spot).alias("source_url"))
