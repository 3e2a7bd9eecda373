"""Exports of a processed corpus: URL list, its test extract, JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.sets import value_counts
from larder.sinks.tables import write_json_documents, write_url_list

# Fixed value: rows of the test extract.
TEST_ROWS = 42


def export(
    dishes: DataFrame, out: str, place: str = "place", test_rows: int = TEST_ROWS
) -> DataFrame:
    """Write the lists and documents of a dish table; returns its rows per source.

    ``place`` is the row's position, as ``placed_recipe_nlg`` gives it: the URL lists keep that
    order, so that their chunks mix the sources.
    """
    urls = dishes.select("uid", "url", place).orderBy(place)
    write_url_list(urls, f"{out}/url_dataset")
    write_url_list(urls.where(F.col(place) < test_rows), f"{out}/url_test")
    write_json_documents(dishes.drop(place), f"{out}/json")
    return value_counts(dishes, "source")
