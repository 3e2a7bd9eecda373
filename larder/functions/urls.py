"""URL columns. Hosts are cut by pattern: ``parse_url`` keeps case and rejects some real hosts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NOT_AVAILABLE = "NA"
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/:?#]*)"
BASE_URL_ENDINGS = [".com", ".net", ".org", ".io", ".dev", ".ai", ".inc", "co"]
SITE_PATTERN = r"https://(?:www\.)?(.*?).com|.net|.io|.org|.dev|.ai|.inc|.co"
GATHERED = "Gathered"


def _or_na(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(NOT_AVAILABLE))


def ensure_https(c: Column, legacy: bool = False) -> Column:
    """Prefix ``https://`` where absent.

    ``http://`` is upgraded; ``legacy`` puts the prefix in front of it instead.
    """
    prefixed = F.concat(F.lit("https://"), c)
    out = F.when(c.startswith("https://"), c)
    if not legacy:
        out = out.when(c.startswith("http://"), F.concat(F.lit("https://"), F.substring(c, 8, 2**30)))
    return out.otherwise(prefixed)


def url_dirname(c: Column) -> Column:
    """Text before the last ``/`` without trailing slashes, or ``NA``."""
    head = F.regexp_extract(c, r"(?s)^(.*)/", 1)
    return _or_na(F.regexp_replace(head, "/+$", ""))


def url_host(c: Column) -> Column:
    """Lower-cased host without user info, port or brackets; null if there is none."""
    host = F.regexp_replace(F.regexp_extract(c, HOST_PATTERN, 1), r"^\[|\]$", "")
    return F.lower(F.nullif(host, F.lit("")))


def extract_base_url(c: Column) -> Column:
    """The first ``www.`` part up to an ending, endings tried in order, or ``NA``."""

    def cut(ending: str) -> Column:
        pattern = rf"(www\..*?{ending.replace('.', chr(92) + '.')})"
        return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))

    return F.when(c.isNotNull(), F.coalesce(*map(cut, BASE_URL_ENDINGS), F.lit(NOT_AVAILABLE)))


def extract_site_source(c: Column) -> Column:
    """Site name before ``.com``; null if only another ending is met; ``NA`` if none is."""
    whole = F.regexp_extract(c, f"({SITE_PATTERN})", 1)
    return (
        F.when(whole == "", F.lit(NOT_AVAILABLE))
        .when(whole.startswith("https://"), F.regexp_extract(c, SITE_PATTERN, 1))
        .otherwise(F.lit(None).cast("string"))
    )


def gathered_source(source: Column, base_url: Column) -> Column:
    """The host stands in for the source of gathered rows."""
    return F.when(source.eqNullSafe(F.lit(GATHERED)), url_host(base_url)).otherwise(source)


def prefix_site(href: Column, root: str, legacy: bool = False) -> Column:
    """Site root plus href; an absolute href is kept unless ``legacy``."""
    joined = F.concat(F.lit(root.rstrip("/")), href)
    if legacy:
        return joined
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit("https:"), href))
        .when(href.startswith("/"), joined)
        .otherwise(F.concat(F.lit(root.rstrip("/") + "/"), href))
    )


def matches_any(c: Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive search for any of the patterns, as one scan."""
    return c.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))
