"""A crawled page as a recipe record, read from its schema.org description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.text import decode_entities
from larder.functions.urls import url_host

_LD_JSON = (
    r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""
)
_DURATION = (
    r"^P(?:(\d+)D)?(?:T(?:(\d+(?:\.\d+)?)H)?(?:(\d+(?:\.\d+)?)M)?(?:(\d+(?:\.\d+)?)S)?)?$"
)
_MINUTES = {1: 1440, 2: 60, 3: 1, 4: 1 / 60}
_VARIANTS = "array<variant>"


def _get(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _is(value: Column, kind: str) -> Column:
    return F.schema_of_variant(value).startswith(kind)


def _objects(doc: Column) -> Column:
    """The described things: list elements, ``@graph`` elements, or the document itself."""
    return F.coalesce(
        _get(doc, "$", _VARIANTS), _get(doc, "$['@graph']", _VARIANTS), F.array(doc)
    )


def recipe_object(html: Column) -> Column:
    """The page's first schema.org Recipe as VARIANT, or null."""
    docs = F.transform(
        F.regexp_extract_all(html, F.lit(_LD_JSON), F.lit(1)), F.try_parse_json
    )
    things = F.flatten(F.transform(F.filter(docs, lambda d: d.isNotNull()), _objects))

    def is_recipe(thing: Column) -> Column:
        kind = _get(thing, "$['@type']")
        return F.coalesce((kind == "Recipe") | kind.contains('"Recipe"'), F.lit(False))

    return F.get(F.filter(things, is_recipe), 0)


def minutes(duration: Column) -> Column:
    """Whole minutes of an ISO 8601 duration or of a plain number; null if unreadable."""
    parts = [
        F.coalesce(F.regexp_extract(duration, _DURATION, group).try_cast("double"), F.lit(0.0))
        * factor
        for group, factor in _MINUTES.items()
    ]
    total = parts[0] + parts[1] + parts[2] + parts[3]
    return F.when(duration.rlike(_DURATION), F.floor(total).cast("bigint")).otherwise(
        duration.try_cast("bigint")
    )


def _text(value: Column) -> Column:
    return _get(value, "$")


def _items(value: Column) -> Column:
    """A list's elements, or the one value."""
    return F.coalesce(_get(value, "$", _VARIANTS), F.when(value.isNotNull(), F.array(value)))


def _names(value: Column, inner: str) -> Column:
    """Texts of a value: a text, an object's ``inner`` text, or a list of either."""

    def name(v: Column) -> Column:
        return F.when(_is(v, "OBJECT"), _get(v, inner)).otherwise(_text(v))

    return F.filter(F.transform(_items(value), name), lambda t: t.isNotNull())


def _first(value: Column, inner: str) -> Column:
    return F.get(_names(value, inner), 0)


def _joined(value: Column) -> Column:
    return F.nullif(F.array_join(_names(value, "$.name"), ","), F.lit(""))


def _steps(given: Column) -> Column:
    """Instruction texts; the steps of a section take the section's place."""
    flat = F.flatten(
        F.transform(
            _items(given), lambda v: F.coalesce(_get(v, "$.itemListElement", _VARIANTS), F.array(v))
        )
    )
    texts = F.transform(
        flat, lambda v: F.when(_is(v, "OBJECT"), _get(v, "$.text")).otherwise(_text(v))
    )
    lines = F.flatten(F.transform(texts, lambda t: F.split(t, "\n")))
    return F.filter(lines, lambda t: F.trim(t) != "")


def _tag_text(html: Column, tag: str) -> Column:
    inner = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    plain = F.regexp_replace(inner, r"(?s)<[^>]*>", "")
    return F.nullif(F.trim(decode_entities(plain)), F.lit(""))


def _meta(html: Column, name: str) -> Column:
    pattern = rf"""(?is)<meta\s[^>]*property\s*=\s*["']{name}["'][^>]*content\s*=\s*["']([^"']*)"""
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def _yields(text: Column) -> Column:
    return F.when(text.rlike(r"^\d+$"), F.concat(text, F.lit(" servings"))).otherwise(text)


# The schema.org properties read.
_PROPERTIES = (
    "name description image author recipeYield prepTime cookTime totalTime recipeIngredient "
    "ingredients recipeInstructions recipeCategory recipeCuisine aggregateRating"
).split()


def page_record(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One recipe record per page: every column but ``html``, plus the record's.

    Title falls back to the first heading, then the page title. The canonical URL is always the
    requested one. Without a Recipe description the recipe columns are null.
    """
    page = F.col(html)
    kept = [c for c in pages.columns if c != html]
    shape = "struct<" + ",".join(f"{p}:variant" for p in _PROPERTIES) + ">"
    # The recipe is found and taken apart once; what is used twice is worked out before the end.
    found = pages.select(*kept, page, _get(recipe_object(page), "$", shape).alias("_r"))
    r = {p: F.col(f"_r.{p}") for p in _PROPERTIES}
    worked = found.withColumns(
        {
            "_steps": _steps(r["recipeInstructions"]),
            "_prep": minutes(_text(r["prepTime"])),
            "_cook": minutes(_text(r["cookTime"])),
            "_yield": _first(r["recipeYield"], "$.value"),
        }
    )
    prep, cook = F.col("_prep"), F.col("_cook")
    title = F.coalesce(_text(r["name"]), _tag_text(page, "h1"), _tag_text(page, "title"))
    ingredients = F.coalesce(
        _names(r["recipeIngredient"], "$.name"), _names(r["ingredients"], "$.name")
    )
    language = F.regexp_extract(page, r"""(?is)<html\b[^>]*\slang\s*=\s*["']?([\w-]+)""", 1)
    return worked.select(
        *kept,
        F.col(url).alias("canonical_url"),
        F.regexp_replace(url_host(F.col(url)), r"^www\.", "").alias("host"),
        title.alias("title"),
        _joined(r["recipeCategory"]).alias("category"),
        _joined(r["recipeCuisine"]).alias("cuisine"),
        _text(r["description"]).alias("description"),
        _first(r["author"], "$.name").alias("author"),
        _first(r["image"], "$.url").alias("image"),
        _yields(F.col("_yield")).alias("yields"),
        F.coalesce(minutes(_text(r["totalTime"])), prep + cook, prep, cook).alias("total_time"),
        cook.alias("cook_time"),
        prep.alias("prep_time"),
        ingredients.alias("ingredients"),
        F.array_join("_steps", "\n").alias("instructions"),
        F.col("_steps").alias("instructions_list"),
        F.nullif(language, F.lit("")).alias("language"),
        _get(r["aggregateRating"], "$.ratingValue").try_cast("double").alias("ratings"),
        _meta(page, "og:site_name").alias("site_name"),
    )
