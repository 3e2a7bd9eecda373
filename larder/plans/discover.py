"""Recipe URL discovery for the two sites, from a table of crawled pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.urls import prefix_site
from larder.operators.pages import (
    MORE_LABEL,
    NAV_ID,
    RECIPE_RULES,
    SECTION_ID_PREFIX,
    anchors,
    labelled_links,
    link_closure,
    may_hold_id,
    may_hold_text,
    nav_links,
    replace_by_label,
    section_links,
)
from larder.plans.scraped import discover_recipe_urls
from larder.session import settle

# The pages each site's discovery starts from.
ALLRECIPES_AZ = [
    "https://www.allrecipes.com/ingredients-a-z-6740416",
    "https://www.allrecipes.com/recipes-a-z-6735880",
]
ALLRECIPES_SEEDS = [
    "https://www.allrecipes.com/recipes/17057/everyday-cooking/more-meal-ideas/5-ingredients/main-dishes/",
    "https://www.allrecipes.com/recipes/1947/everyday-cooking/quick-and-easy/",
    "https://www.allrecipes.com/recipes/17485/everyday-cooking/quick-and-easy/breakfast-and-brunch/",
    "https://www.allrecipes.com/recipes/455/everyday-cooking/more-meal-ideas/30-minute-meals/",
    "https://www.allrecipes.com/recipes/17561/lunch/",
    "https://www.allrecipes.com/recipes/841/holidays-and-events/christmas/desserts/christmas-cookies/",
]
FOODDOTCOM_SEEDS = [
    "https://www.food.com/ideas/top-breakfast-recipes-6935#c-796349",
    "https://www.food.com/ideas/quick-easy-pasta-recipes-6078",
    "https://www.food.com/ideas/fun-salad-ideas-6301?ref=nav",
    "https://www.food.com/ideas/copycat-recipes-6576?ref=nav",
]
FOODDOTCOM_ROOT = "https://www.food.com"
FOODDOTCOM_NAV = "https://www.food.com/?ref=nav"


def _urls(like: DataFrame, urls: Sequence[str]) -> DataFrame:
    return like.sparkSession.createDataFrame([(u,) for u in urls], "url string")


def allrecipes_urls(
    pages: DataFrame,
    az_pages: Sequence[str] = ALLRECIPES_AZ,
    seeds: Sequence[str] = ALLRECIPES_SEEDS,
) -> DataFrame:
    """Recipe links on the A-Z sections' pages and on the seed pages."""
    named = pages.join(F.broadcast(_urls(pages, az_pages)), "url", "left_semi")
    found = anchors(named.where(may_hold_id(F.col("html"), SECTION_ID_PREFIX)), ["url"])
    sections = section_links(found).select(F.col("href").alias("url"))
    none = _urls(pages, [])
    rules = {"allrecipes": RECIPE_RULES["allrecipes"]}
    return discover_recipe_urls(pages, _urls(pages, seeds), sections, none, rules)


def fooddotcom_base_pages(
    pages: DataFrame,
    seeds: Sequence[str] = FOODDOTCOM_SEEDS,
    nav_url: str = FOODDOTCOM_NAV,
    root: str = FOODDOTCOM_ROOT,
    legacy: bool = False,
) -> DataFrame:
    """Distinct pages that list recipes: the seeds and all pages their labelled links lead to,
    and the navigation's pages, replaced by their labelled links where they have some.

    Only pages that may have the label, and the navigation's page, are parsed in Python.
    """
    html = F.col("html")
    found = anchors(pages.where(may_hold_text(html, MORE_LABEL)), ["url"])
    labelled = settle(labelled_links(found).select("url", "href"), "labelled")
    edges = labelled.select(F.col("url").alias("src"), F.col("href").alias("dst"))
    closure = link_closure(_urls(pages, seeds).withColumnRenamed("url", "node"), edges)
    start = pages.where((F.col("url") == nav_url) & may_hold_id(html, NAV_ID))
    nav = nav_links(anchors(start, ["url"])).select(
        prefix_site(F.col("href"), root, legacy).alias("url")
    )
    return (
        closure.select(F.col("node").alias("url"))
        .unionByName(replace_by_label(nav, labelled))
        .distinct()
    )


def fooddotcom_urls(pages: DataFrame, **options) -> DataFrame:
    base = fooddotcom_base_pages(pages, **options)
    none = _urls(pages, [])
    rules = {"fooddotcom": RECIPE_RULES["fooddotcom"]}
    return discover_recipe_urls(pages, none, none, base, rules)


def all_recipe_urls(pages: DataFrame) -> DataFrame:
    """Recipe links of both sites, duplicates kept."""
    return allrecipes_urls(pages).unionByName(fooddotcom_urls(pages))
