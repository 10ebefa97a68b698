"""Text rules of registry and catalogue records, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference(raw: Column) -> Column:
    """A cadastral reference, trimmed and in upper case, of 14, 18 or 20 letters and digits; else NULL."""
    own = F.upper(F.trim(raw))
    return F.when(own.rlike("^[0-9A-Z]+$") & F.length(own).isin(14, 18, 20), own)


def reference_root(raw: Column) -> Column:
    return F.substring(reference(raw), 1, 14)


def crs(raw: Column) -> Column:
    """EPSG:n from EPSG:n or a URN of it; else NULL."""
    code = F.regexp_extract(raw, r"^(?:urn:ogc:def:crs:)?EPSG(?:::|:)(\d+)$", 1)
    return F.when(code != "", F.concat(F.lit("EPSG:"), code))


def is_web_url(url: Column) -> Column:
    return url.rlike(r"^https?://[^/?#\s]+")


def safe_name(raw: Column) -> Column:
    return F.regexp_replace(raw, r"[^A-Za-z0-9._-]", "_")


def visible(html: Column) -> Column:
    """HTML without tags, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"<[^>]*>", " "), r"[ \t\r\n]+", " "))


def tags(html: Column) -> Column:
    """Names of the opening tags in order."""
    return F.regexp_extract_all(html, F.lit(r"<([a-zA-Z][a-zA-Z0-9]*)"), 1)


def image_size(extent_x: Column, extent_y: Column, pixel: float, limit: int = 4096) -> tuple[Column, Column]:
    """Columns and rows of an image; NULL where a side would be none or beyond the limit."""
    size = [F.ceil(e / pixel) for e in (extent_x, extent_y)]
    ok = (F.least(*size) > 0) & (F.greatest(*size) <= limit)
    return F.when(ok, size[0]), F.when(ok, size[1])


def positions(text: Column) -> Column:
    """Array of (x, y) from a list of numbers between white space; NULL where their number is odd."""
    n = F.filter(F.split(F.trim(text), r"\s+"), lambda x: x != "")
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(n) - 2, F.lit(0)), F.lit(2)), lambda i: F.struct(F.get(n, i).cast("double").alias("x"), F.get(n, i + 1).cast("double").alias("y")))
    return F.when((F.size(n) % 2 == 0) & (F.size(n) > 0), pairs)
