"""Scalar column functions: safe arithmetic, distance, URL parts, slugs, buckets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratavault.functions.keys import ColumnLike, _column

# Earth radius in miles, kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def safe_add(*fields: ColumnLike) -> Column:
    """Sum in which a null counts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(_column(f), F.lit(0)) for f in fields])


def safe_subtract(*fields: ColumnLike) -> Column:
    """First field minus the others; a null counts as zero."""
    return reduce(lambda a, b: a - b, [F.coalesce(_column(f), F.lit(0)) for f in fields])


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient, or null when the divisor is zero or null."""
    return F.try_divide(_column(numerator), _column(denominator))


def width_bucket(value: ColumnLike, low: ColumnLike | float, high: ColumnLike | float, buckets: ColumnLike | int) -> Column:
    """Equal-width bucket number: 0 below ``low``, ``buckets + 1`` from ``high`` on."""
    def arg(x):
        return F.lit(x) if isinstance(x, (int, float)) else _column(x)
    return F.width_bucket(_column(value).cast("double"), arg(low).cast("double"), arg(high).cast("double"), arg(buckets).cast("bigint"))


def haversine_distance(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike, unit: str = "mi") -> Column:
    """Great-circle distance of two points in degrees, in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    a1, o1, a2, o2 = (_column(c).cast("double") for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians((a2 - a1) / 2))
    half_lon = F.sin(F.radians((o2 - o1) / 2))
    chord = half_lat * half_lat + F.cos(F.radians(a1)) * F.cos(F.radians(a2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(chord)) * F.lit(1.0 if unit == "mi" else KM_PER_MILE)


def _without(c: Column, *texts: str) -> Column:
    for text in texts:
        c = F.replace(c, F.lit(text), F.lit(""))
    return c


def _part(c: Column, delimiter: str, number: int) -> Column:
    return F.split_part(c, F.lit(delimiter), F.lit(number))


def url_host(url: ColumnLike) -> Column:
    """Host of a URL, with or without scheme."""
    bare = _without(_column(url), "android-app://", "http://", "https://")
    return _part(_part(bare, "/", 1), "?", 1)


def url_path(url: ColumnLike) -> Column:
    """Path after the first slash (or before ``?`` when there is none), without the query string."""
    bare = _without(_column(url), "http://", "https://")
    cut = F.coalesce(F.nullif(F.locate("/", bare), F.lit(0)), F.locate("?", bare) - 1)
    return _part(F.right(bare, F.length(bare) - cut), "?", 1)


def url_parameter(url: ColumnLike, name: str) -> Column:
    """Value of one query parameter, null when missing or empty."""
    return F.nullif(_part(_part(_column(url), f"{name}=", 2), "&", 1), F.lit(""))


def slugify(text: ColumnLike) -> Column:
    """Lower-case identifier text: blanks and dashes to ``_``, the rest dropped, never a leading digit."""
    c = F.lower(F.coalesce(_column(text).cast("string"), F.lit("")))
    c = F.regexp_replace(c, "[ -]+", "_")
    c = F.regexp_replace(c, "[^a-z0-9_]+", "")
    return F.regexp_replace(c, "^([0-9])", "_$1")


def slug(text: str | None) -> str:
    """The same rule for a column name known while a plan is being built."""
    import re

    kept = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", (text or "").lower()))
    return "_" + kept if kept[:1].isdigit() else kept
