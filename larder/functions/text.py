"""Text cleaning columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters and names the cleaning rules are defined by.
CONTROL = r"[\x00-\x19]"
NOT_ALPHA = "[^A-Za-z ]"
NOT_ALNUM = "[^A-Za-z0-9 ]+"
NOT_WORD = r"[^\p{L}\p{N}_]"
NOT_FILENAME = "[^a-zA-Z0-9_]"
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
NOT_WHITESPACE = r"(?U)[^\s\x1c-\x1f]"
MISSING = "missing"


def strip_control(c: Column) -> Column:
    """Remove 0x00-0x19, tab and newline included."""
    return F.regexp_replace(c, CONTROL, "")


def strip_control_list(c: Column) -> Column:
    return F.transform(c, strip_control)


def alpha_only(c: Column) -> Column:
    """Keep ASCII letters and blanks, then trim."""
    return F.trim(F.regexp_replace(c, NOT_ALPHA, ""))


def alpha_only_list(c: Column) -> Column:
    return F.transform(c, alpha_only)


def missing_if_blank(c: Column) -> Column:
    """An empty or null text becomes ``missing``."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(MISSING))


def make_uid(dish: Column, n: Column) -> Column:
    """Lower-cased word characters of the dish name, ``_``, row number."""
    slug = F.regexp_replace(F.lower(dish), NOT_WORD, "")
    return F.concat(slug, F.lit("_"), n.cast("string"))


def collapse_ws(c: Column) -> Column:
    """One blank for each run of whitespace, lower-cased."""
    return F.lower(F.regexp_replace(c, WHITESPACE, " "))


def is_blank(c: Column) -> Column:
    return ~c.rlike(NOT_WHITESPACE)


def non_blank_items(c: Column) -> Column:
    """List elements that hold more than whitespace."""
    return F.filter(c, lambda x: ~is_blank(x))


def clean_text(c: Column) -> Column:
    """Per element: drop all but letters, digits, blanks; drop blank elements; lower-case."""
    kept = non_blank_items(F.transform(c, lambda x: F.regexp_replace(x, NOT_ALNUM, "")))
    return F.transform(kept, F.lower)


def split_text(c: Column) -> Column:
    """All words of a list of texts."""
    words = F.split(F.array_join(c, " "), WHITESPACE)
    return F.filter(words, lambda x: x != "")


def json_filename(dish_id: Column, source: Column) -> Column:
    """``<dish_id>_<source>.json`` with other characters of the source as ``_``."""
    safe = F.regexp_replace(F.coalesce(source, F.lit("")), NOT_FILENAME, "_")
    return F.concat(dish_id.cast("string"), F.lit("_"), safe, F.lit(".json"))


def truncate_filename(c: Column, max_chars: int = 1024) -> Column:
    suffix = ".json"
    return F.concat(F.substring(c, 1, max_chars - len(suffix)), F.lit(suffix))


# The entities decoded, the ampersand last.
_ENTITIES = [("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def decode_entities(c: Column) -> Column:
    """The common HTML entities as characters."""
    for entity, char in _ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c
