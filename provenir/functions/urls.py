"""URLs in canonical form, in built-in functions throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track.
TRACKING = ("fbclid", "gclid", "ref", "referrer", "source", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:@]*)(?::(\d*))?(/[^?#]*)?(?:\?([^#]*))?(?:#.*)?$"


def _decoded(text: Column) -> Column:
    """Percent signs that start no escape stand for themselves."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")), text)


def _encoded(text: Column) -> Column:
    """Percent-encoding with + for spaces; ~ stays and * does not."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(raw: Column) -> Column:
    pairs = F.transform(F.filter(F.split(raw, "&"), lambda p: p != ""), lambda p: F.struct(
        _decoded(F.regexp_extract(p, r"^([^=]*)", 1)).alias("k"), _decoded(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("v")))
    kept = F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*TRACKING) & ~F.lower(p["k"]).startswith("utm_"))
    return F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def canonical_url(url: Column) -> Column:
    """An http or https URL in one spelling, or null.

    Scheme and host in lower case (IDNA), no user, default port, fragment or tracking parameters, slashes not
    doubled nor last, parameters sorted. A malformed URL is null.
    """
    trimmed = F.regexp_replace(url, r"^(?U)[\s\x1c-\x1f]+|(?U)[\s\x1c-\x1f]+$", "")
    part = lambda k: F.regexp_extract(trimmed, _PARTS, k)
    scheme, raw_host, port = F.lower(part(1)), part(2), part(3)
    host = F.when(raw_host.rlike(r"^[\x00-\x7F]*$"), F.lower(raw_host)).otherwise(F.lower(F.reflect(F.lit("java.net.IDN"), F.lit("toASCII"), F.lower(raw_host))))
    plain = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    path = F.regexp_replace(F.coalesce(F.nullif(part(4), F.lit("")), F.lit("/")), "/{2,}", "/")
    path = F.when(path == "/", path).otherwise(F.regexp_replace(path, "/+$", ""))
    query = _query(part(5))
    made = F.concat(scheme, F.lit("://"), host, F.when(plain, F.lit("")).otherwise(F.concat(F.lit(":"), port)), path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))
    return F.when(scheme.isin("http", "https") & (raw_host != ""), made)


def domain_of(canonical: Column) -> Column:
    """Host of a canonical URL without a leading www."""
    host = F.regexp_extract(canonical, r"^https?://([^/:?#]+)", 1)
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def syntactically_public(url: Column) -> Column:
    """The part of the safety rule that needs no name lookup: http(s), a host, no credentials."""
    return F.coalesce(url.rlike(r"^(?i)https?://[^/?#@]+(?:[/?#]|$)"), F.lit(False))
