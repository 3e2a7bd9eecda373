"""Batch cleaning of raw corpora: per dataset, then the master table and its vocabularies."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.coerce import to_float_or_zero, to_int_or_zero
from larder.functions.lists import lowercase_sort, parse_py_list, wrap_json
from larder.functions.text import (
    alpha_only_list,
    make_uid,
    missing_if_blank,
    strip_control,
    strip_control_list,
)
from larder.functions.urls import ensure_https, gathered_source, url_dirname
from larder.operators.index import sorted_index, with_index
from larder.operators.sets import exclude_sources, exclude_urls, union_all
from larder.operators.vocab import (
    ingredient_counts,
    largest_id,
    merged_counts,
    ranked_words,
    unique_ingredients,
)
from larder.schemas import DISH, DISH_COLUMNS
from larder.session import settle
from larder.sinks.tables import dataset_path, write_dataset, write_table
from larder.sources.corpus import discover_specs, land_raw, raw_path, unprocessed
from larder.sources.tables import read_processed

# Known bad sources and links of the corpus, and the size of the small extract.
BAD_SOURCES = ["www.cookbooks.com"]
BAD_URLS = ["www.epicurious.com/recipes/member", "recipes-plus"]
SMALL_ROWS = 750_000

LIST_COLUMNS = ["ingredients", "quantities", "directions"]
CLEAN_COLUMNS = [
    *[c for c in DISH_COLUMNS if c not in ("dish_id", "img", "source")],
    "base_url",
    "img",
    "source",
]


def clean_raw(df: DataFrame, legacy: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Raw corpus rows, numbered by ``n``, as cleaned dishes with list columns.

    ``bad_list`` marks rows whose list texts cannot be read; see ``split_rejects``.
    """
    renamed = df.select(
        *keep,
        "n",
        F.col("title").alias("dish"),
        parse_py_list(F.col("NER")).alias("ingredients"),
        parse_py_list(F.col("ingredients")).alias("quantities"),
        parse_py_list(F.col("directions")).alias("directions"),
        ensure_https(F.col("link"), legacy).alias("url"),
        "source",
    )
    dish = missing_if_blank(strip_control(F.col("dish")))
    no_number = F.lit(None).cast("string")
    bad = F.col("ingredients").isNull()
    for column in LIST_COLUMNS[1:]:
        bad = bad | F.col(column).isNull()
    cleaned = renamed.withColumns(
        {
            "bad_list": bad,
            "dish": dish,
            "uid": make_uid(dish, F.col("n")),
            "ingredients": lowercase_sort(alpha_only_list(F.col("ingredients"))),
            "quantities": strip_control_list(F.col("quantities")),
            "directions": strip_control_list(F.col("directions")),
            "description": F.lit(""),
            "prep_time": to_int_or_zero(no_number),
            "cook_time": to_int_or_zero(no_number),
            "total_time": to_int_or_zero(no_number),
            "ratings": to_float_or_zero(no_number),
            "yields": F.lit(""),
            "category": F.lit(None).cast("string"),
            "cuisine": F.lit(None).cast("string"),
            "img": F.lit("NA"),
            "base_url": url_dirname(F.col("url")),
        }
    ).withColumn("source", gathered_source(F.col("source"), F.col("base_url")))
    return cleaned.select(*keep, "n", *CLEAN_COLUMNS, "bad_list")


def split_rejects(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """Rows that are fine, and rows that are not. Settle an expensive frame first."""
    marked = F.coalesce(F.col(flag), F.lit(False))
    return df.where(~marked).drop(flag), df.where(marked).drop(flag)


def wrap_lists(df: DataFrame, columns: Sequence[str] = LIST_COLUMNS) -> DataFrame:
    return df.withColumns({c: wrap_json(F.col(c), c) for c in columns})


def keep_good(dishes: DataFrame) -> DataFrame:
    """Dishes without the known bad sources and links."""
    return exclude_urls(exclude_sources(dishes, BAD_SOURCES), BAD_URLS)


def recipe_nlg(cleaned: DataFrame) -> DataFrame:
    """Good dishes with list columns and ``source_order``, their place within their source."""
    dishes = keep_good(cleaned.withColumn("dish_id", F.col("n")))
    return with_index(dishes, "dish_id", "source_order", by=["source"])


def interleaved() -> list[Column]:
    """The order in which the sources alternate."""
    return [F.asc_nulls_last("source_order"), F.asc_nulls_last("source"), F.col("dish_id")]


REJECT_COLUMNS = ["n", "uid", "dish", "url"]


def _ordered_dishes(raw: DataFrame, rejects: str, legacy: bool) -> DataFrame:
    # Settled before the split: a filter on what Python read would read it in Python again.
    cleaned, bad = split_rejects(settle(clean_raw(raw, legacy), "cleaned"), "bad_list")
    write_table(bad.select(*REJECT_COLUMNS), rejects)
    return recipe_nlg(cleaned)


def process_recipe_nlg(raw: DataFrame, rejects: str, legacy: bool = False) -> DataFrame:
    """The dish table of one raw corpus, sources interleaved.

    Rows whose lists cannot be read are written as a table to the path ``rejects``.
    """
    ordered = _ordered_dishes(raw, rejects, legacy).orderBy(*interleaved())
    return wrap_lists(ordered).select(*DISH_COLUMNS)


def placed_recipe_nlg(raw: DataFrame, rejects: str, legacy: bool = False) -> DataFrame:
    """The same table with ``place``, each row's position in that order."""
    placed = sorted_index(_ordered_dishes(raw, rejects, legacy), interleaved(), "place")
    return wrap_lists(placed).select(*DISH_COLUMNS, "place")


Processor = Callable[[DataFrame], DataFrame]
# Spec -> what turns its cleaned rows into dishes with ``dish_id`` and ``source_order``.
PROCESSORS: dict[str, Processor] = {"recipeNLG": recipe_nlg}


@dataclass
class BatchResult:
    """What a batch run did, and the tables it left."""

    processed: list[str]
    skipped: list[str]
    master: DataFrame | None = None
    rejects: DataFrame | None = None


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_processed(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


_DATASETS = "at timestamp, rows long, spec string"
_PLACES = "start long, spec string"
_WORDS = "ingredients string, count long, first_id long, first_pos long, spec string"
MASTER = T.StructType(
    [T.StructField("master_id", T.LongType()), *DISH.fields, T.StructField("spec", T.StringType())]
)


@dataclass
class Placed:
    """A dataset's place in the master table: datasets follow one another by name."""

    spec: str
    rows: int
    start: int


def _placed(datasets: DataFrame | None) -> list[Placed]:
    """All processed datasets in order; a row for each comes to the driver."""
    rows = [] if datasets is None else datasets.select("spec", "rows").collect()
    out, start = [], 0
    for spec, n in sorted((row["spec"], row["rows"]) for row in rows):
        out.append(Placed(spec, n, start))
        start += n
    return out


def _table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """A table of datasets, or None before its first dataset was written."""
    if _read_if_there(spark, path) is None:
        return None
    return spark.read.schema(schema).parquet(path)


def dish_rows(stored: DataFrame, start: int) -> DataFrame:
    """A dataset's rows, which know their ``place`` in it, as rows of the master table."""
    return wrap_lists(stored.withColumn("master_id", F.col("place") + start)).select(
        "master_id", *DISH_COLUMNS
    )


def _write_small(
    spark: SparkSession, processed_dir: str, output_dir: str, head: list[Placed], small_rows: int
) -> None:
    """The first rows of the master table and their vocabulary, from the datasets they come from."""
    parts = []
    for dataset in head:
        stored = spark.read.parquet(dataset_path(processed_dir, dataset.spec))
        own = stored.where(F.col("place") < small_rows - dataset.start)
        numbered = own.withColumn("master_id", F.col("place") + dataset.start)
        parts.append(numbered.withColumn("spec", F.lit(dataset.spec)))
    small = union_all(parts)
    columns = ["master_id", "spec", *DISH_COLUMNS]
    write_table(wrap_lists(small).select(*columns), f"{output_dir}/dish_recipes_small")
    words = unique_ingredients(small, "master_id", "ingredients")
    write_table(words, f"{output_dir}/unique_ingredients_small")


def _process(
    spark: SparkSession, raw: DataFrame, processor: Processor, processed_dir: str, output_dir: str,
    spec: str,
) -> None:
    """One dataset: its rejects, its rows in their order, the counts of its words, its size."""
    cleaned = settle(clean_raw(raw, keep=["spec"]), "cleaned")
    good, bad = split_rejects(cleaned, "bad_list")
    write_dataset(bad.select(*REJECT_COLUMNS), f"{output_dir}/rejects", spec)
    placed = sorted_index(processor(good), interleaved(), "place")
    write_dataset(placed, processed_dir, spec)
    stored = spark.read.schema(placed.schema).parquet(dataset_path(processed_dir, spec))
    words = ingredient_counts(stored, "place", "ingredients", largest_id(stored, "place"))
    write_dataset(words, f"{output_dir}/word_counts", spec)
    size = stored.agg(F.now().alias("at"), F.count(F.lit(1)).alias("rows"))
    write_dataset(size, f"{output_dir}/datasets", spec)


def run_batch(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str,
    output_dir: str,
    reprocess: bool = False,
    processors: dict[str, Processor] | None = None,
    raw_schema: T.StructType | None = None,
    multi_line: bool = True,
    small_rows: int = SMALL_ROWS,
) -> BatchResult:
    """Clean every raw dataset not yet processed; bring the processed tables, the master table,
    its first rows, and the vocabularies of both up to date.

    The cost follows the new datasets. Each keeps the counts of its own words, and the vocabulary is
    merged from these. The master table has a folder for each dataset, written anew only if the
    dataset is new or earlier datasets moved its rows; the first rows and their vocabulary only if
    they changed. Names and sizes of the datasets are the only thing brought to the driver. A
    dataset without a processor is skipped and reported. Rejected rows are kept in the table
    ``rejects`` and every dataset that was processed, with rows or without, in ``datasets``.
    """
    processors = PROCESSORS if processors is None else processors
    before = _table(spark, f"{output_dir}/datasets", _DATASETS)
    done = None if before is None else before.select("spec")
    specs = unprocessed(discover_specs(spark, raw_dir), done, reprocess)
    result = BatchResult(processed=[], skipped=[])
    options = {} if raw_schema is None else {"schema": raw_schema}
    for spec in sorted(row["spec"] for row in specs.collect()):
        processor = processors.get(spec)
        if processor is None:
            result.skipped.append(spec)
            continue
        raw = land_raw(spark, raw_path(raw_dir, spec), multi_line=multi_line, **options)
        _process(spark, raw, processor, processed_dir, output_dir, spec)
        result.processed.append(spec)
    result.rejects = _read_if_there(spark, f"{output_dir}/rejects")
    datasets = _placed(_table(spark, f"{output_dir}/datasets", _DATASETS))
    if not datasets:
        return result

    master = f"{output_dir}/dish_recipes"
    places = _table(spark, f"{output_dir}/places", _PLACES)
    known = {} if places is None else {r["spec"]: r["start"] for r in places.collect()}
    moved = {d.spec for d in datasets if d.spec in result.processed or known.get(d.spec) != d.start}
    for dataset in datasets:
        if dataset.spec in moved:
            stored = spark.read.parquet(dataset_path(processed_dir, dataset.spec))
            write_dataset(dish_rows(stored, dataset.start), master, dataset.spec)
            place = spark.range(1).select(F.lit(dataset.start).cast("bigint").alias("start"))
            write_dataset(place, f"{output_dir}/places", dataset.spec)
    head = [d for d in datasets if d.start < small_rows]
    if moved.intersection(d.spec for d in head):
        _write_small(spark, processed_dir, output_dir, head, small_rows)
    if moved:
        starts = [(d.spec, d.start) for d in datasets]
        words = merged_counts(
            spark.read.schema(_WORDS).parquet(f"{output_dir}/word_counts"),
            spark.createDataFrame(starts, "spec string, _start long"),
            "spec",
        )
        write_table(ranked_words(words), f"{output_dir}/unique_ingredients")
    columns = ["master_id", "spec", *DISH_COLUMNS]
    result.master = spark.read.schema(MASTER).parquet(master).select(*columns)
    return result
