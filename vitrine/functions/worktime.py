"""Opening hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIME = r"([0-9]{1,2}(?:[:.][0-9]{2})?)"
_RANGE = rf"^{_TIME}\s*-\s*{_TIME}$"
#: Shapes of a range in a text, in order of precedence: minutes on both sides, on the right, on the left, on none.
_HOUR, _CLOCK, _DASH = "[0-9]{1,2}", "[0-9]{1,2}[:.][0-9]{2}", "\\s*[-—]\\s*"
SHAPES = [rf"(?U)\b({a}{_DASH}{b})\b" for a, b in ((_CLOCK, _CLOCK), (_HOUR, _CLOCK), (_CLOCK, _HOUR), (_HOUR, _HOUR))]


def time_token(c: Column) -> Column:
    """T3. 8 and 8.30 become 08:00 and 08:30."""
    x = F.replace(F.trim(c), F.lit("."), F.lit(":"))
    p = F.split(x, ":")
    return F.concat(F.lpad(p[0], 2, "0"), F.lit(":"), F.coalesce(F.get(p, F.lit(1)), F.lit("00")))


def clean_work_time(c: Column) -> Column:
    """T2. White space and dashes put in order; a plain range becomes HH:MM-HH:MM; other text stays."""
    x = F.regexp_replace(F.btrim(F.regexp_replace(c, r"(?U)\s+", " "), F.lit(" ,;")), r"\s*[-–—]\s*", "-")
    a, b = F.regexp_extract(x, _RANGE, 1), F.regexp_extract(x, _RANGE, 2)
    return F.when(F.lower(x).contains("круглосуточ"), "круглосуточно").when(a != "", F.concat_ws("-", time_token(a), time_token(b))).when(x != "", x)


def find_work_time(c: Column) -> Column:
    """T1. Round the clock, or the first range by precedence of its shape."""
    x = F.regexp_replace(c, r"(?U)\s+", " ")
    found = F.coalesce(*[F.nullif(F.regexp_extract(x, s, 1), F.lit("")) for s in SHAPES])
    return F.when(F.lower(x).contains("круглосуточ"), "круглосуточно").otherwise(clean_work_time(found))
