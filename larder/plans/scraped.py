"""Scraped records: pages to records to dishes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.coerce import has_fraction, to_float_or_zero, to_int_or_zero
from larder.functions.lists import lowercase_sort, split_commas, wrap_json
from larder.functions.text import (
    alpha_only_list,
    make_uid,
    missing_if_blank,
    strip_control,
    strip_control_list,
)
from larder.operators.index import seeded_shuffle
from larder.operators.pages import RECIPE_RULES, extract_links, recipe_links, top_links
from larder.operators.records import fill_text, overlay, sanitize
from larder.operators.recipes import page_record
from larder.operators.sets import union_all
from larder.operators.tags import with_tags
from larder.schemas import SCRAPED_DISH_COLUMNS
from larder.session import settle
from larder.sources.tables import pages_for

TIME_COLUMNS = ["prep_time", "cook_time", "total_time"]


def clean_scraped(df: DataFrame, legacy_keys: bool = False) -> DataFrame:
    """Scraped records, numbered by ``n``, as dishes.

    ``bad_time`` marks rows with a fractional minute value, which the dish table cannot hold.
    ``legacy_keys`` stores the cuisine under the key ``category``.
    """

    def comma_list(name: str):
        return strip_control_list(split_commas(missing_if_blank(strip_control(F.col(name)))))

    dish = missing_if_blank(strip_control(F.col("title")))
    bad_time = has_fraction(F.col(TIME_COLUMNS[0]))
    for column in TIME_COLUMNS[1:]:
        bad_time = bad_time | has_fraction(F.col(column))
    tags = lowercase_sort(alpha_only_list(F.col("ingredient_tags")))
    return df.select(
        F.col("n").alias("dish_id"),
        make_uid(dish, F.col("n")).alias("uid"),
        dish.alias("dish"),
        wrap_json(tags, "ingredients").alias("ingredients"),
        wrap_json(strip_control_list(F.col("ingredients")), "quantities").alias("quantities"),
        wrap_json(strip_control_list(F.col("instructions_list")), "directions").alias(
            "directions"
        ),
        "description",
        *(to_int_or_zero(F.col(c)).alias(c) for c in TIME_COLUMNS),
        "yields",
        wrap_json(comma_list("category"), "category").alias("category"),
        wrap_json(comma_list("cuisine"), "category" if legacy_keys else "cuisine").alias("cuisine"),
        to_float_or_zero(F.col("ratings")).alias("ratings"),
        F.col("canonical_url").alias("url"),
        F.col("host").alias("base_url"),
        F.col("image").alias("img"),
        F.col("site_name").alias("source"),
        bad_time.alias("bad_time"),
    ).select(*SCRAPED_DISH_COLUMNS, "bad_time")


def discover_recipe_urls(
    pages: DataFrame,
    starts: DataFrame,
    sections: DataFrame,
    closure: DataFrame,
    rules: dict[str, str],
    url: str = "url",
) -> DataFrame:
    """Recipe links found on the given pages, duplicates kept.

    ``starts``, ``sections`` and ``closure`` each hold page addresses in ``url``. A page listed by
    several of them is read for each, as a page reached twice is.
    """
    wanted = union_all([f.select(url) for f in (starts, sections, closure)])
    links = settle(recipe_links(extract_links(pages_for(wanted, pages), [url]), rules), "links")
    return wanted.join(links, url).select(
        F.col(url).alias("page"), "pos", "site", F.col("href").alias(url)
    )


def scrape_batch(
    urls: DataFrame, pages: DataFrame, vocab: DataFrame, seed: int = 0
) -> DataFrame:
    """Recipe URLs, numbered by ``n``, looked up in the pages and cleaned into dishes.

    ``pages`` must hold one page per URL. URLs without a page are left to the failure table.
    """
    records = settle(page_record(pages_for(urls, pages)), "records")
    found = fill_text(overlay(urls, records, "url", how="inner"))
    tagged = with_tags(found, "n", "ingredients", vocab)
    return seeded_shuffle(clean_scraped(tagged), "url", seed)


def scrape_recipes(base_pages: DataFrame, pages: DataFrame, limit: int) -> DataFrame:
    """Records of the first ``limit`` recipe links of each base page, with that page's URL."""
    links = top_links(base_pages, ["url"], limit, RECIPE_RULES["allrecipes"])
    wanted = links.select(F.col("url").alias("base_url"), "pos", F.col("href").alias("url"))
    records = settle(page_record(pages_for(wanted, pages)), "records")
    return overlay(wanted, records, "url", how="inner").select(
        "base_url", "pos", "url", "title", "total_time", "ingredients", "instructions", "image"
    )


def tag_records(
    records: DataFrame, vocab: DataFrame, key: str = "path"
) -> DataFrame:
    """VARIANT records tagged by their ingredients, then sanitized. ``key`` must be unique."""
    lines = F.try_variant_get(F.col("record"), "$.ingredients", "array<string>")
    tagged = with_tags(
        records.withColumn("_lines", lines), key, "_lines", vocab, name="_tags"
    )
    clean = sanitize(tagged, "record", keep=[key, "_tags"])
    return clean.withColumn("ingredient_tags", F.col("_tags")).drop("_tags")
