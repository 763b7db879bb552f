"""Sound, spelling and distance (Column to Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM, SAME_SITE_KM, FAR_KM = 6371.0, 0.15, 2.0


def soundex(c: Column) -> Column:
    letters = F.regexp_replace(c, "[^A-Za-z]", "")
    return F.coalesce(F.soundex(F.upper(letters)), F.lit(""))


def trigrams(c: Column) -> Column:
    """The distinct trigrams of the lower-cased text between two and one spaces."""
    padded = F.concat(F.lit("  "), F.lower(c), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


def trigram_similarity(a: Column, b: Column) -> Column:
    missing = a.isNull() | b.isNull() | (a == "") | (b == "")
    shared = F.size(F.array_intersect(trigrams(a), trigrams(b)))
    return F.when(missing, 0.0).when(a == b, 1.0).otherwise(shared / F.size(F.array_union(trigrams(a), trigrams(b))))


def set_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets made before the pairing (null: no text)."""
    shared = F.size(F.array_intersect(a, b))
    return F.when(a.isNull() | b.isNull(), 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = lambda x: F.pow(F.sin(x / 2), 2)
    h = half(F.radians(lat2 - lat1)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(F.radians(lon2 - lon1))
    return 2 * EARTH_KM * F.asin(F.sqrt(h))


def site_similarity(km: Column) -> Column:
    """1 at one site, then falling to 0 at two kilometres; null without a distance."""
    return F.when(km <= SAME_SITE_KM, 1.0).otherwise(F.greatest(1 - km / FAR_KM, F.when(km.isNotNull(), 0.0)))
