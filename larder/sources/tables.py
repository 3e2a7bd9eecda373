"""Page tables, processed tables and multi-file unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.sets import union_all
from larder.operators.sizes import broadcast_if_small
from larder.schemas import PAGE
from larder.session import settle


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Crawled pages ``url, html``."""
    return spark.read.schema(PAGE).parquet(path)


def latest_pages(pages: DataFrame, order: str, url: str = "url") -> DataFrame:
    """One page per URL, the one with the greatest ``order`` value, which must be unique.

    Only URL and order are aggregated; the text follows by a semi-join.
    """
    last = pages.groupBy(url).agg(F.max(order).alias(order))
    return pages.join(last, [url, order], "left_semi")


def one_page(pages: DataFrame, newest: str | None = None, url: str = "url") -> DataFrame:
    """One page per URL: the one with the greatest ``newest``, else of the greatest content hash."""
    rest = [c for c in pages.columns if c != url]
    plain = [c for c, kind in pages.dtypes if c != url and not kind.startswith(("map", "variant"))]
    order = F.struct(*([newest] if newest else []), F.xxhash64(*plain) if plain else F.lit(0))
    best = F.max_by(F.struct(*rest), order).alias("_best")
    return pages.groupBy(url).agg(best).select(url, "_best.*").select(*pages.columns)


def read_processed(spark: SparkSession, path: str, spec: str | None = None) -> DataFrame:
    """Processed tables, or one dataset's by partition pruning. Names of datasets stay text."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == "spec" else f for f in found]
    table = spark.read.schema(T.StructType(fields)).parquet(path)
    return table if spec is None else table.where(F.col("spec") == spec)


def read_all(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet tables of differing schemas as one; a column a table lacks is null."""
    return union_all([spark.read.parquet(p) for p in paths])


#: URLs a lookup names to the scan one by one; their texts stay well under a megabyte.
LOOKUP_URLS = 4096


def page_bucket(url: Column, buckets: int | Column) -> Column:
    """Folder a page is stored under, see ``write_pages``: its number and how many there are."""
    count = F.lit(buckets) if isinstance(buckets, int) else buckets
    number = F.pmod(F.xxhash64(url), count)
    return F.concat(number.cast("string"), F.lit("of"), count.cast("string"))


def bucket_count(pages: DataFrame) -> int | None:
    """How many folders ``write_pages`` dealt the pages to; None for other tables and empty ones."""
    if "url_bucket" not in pages.columns:
        return None
    row = pages.select("url_bucket").where(F.col("url_bucket").isNotNull()).first()
    return None if row is None else int(row[0].rsplit("of", 1)[1])


def pages_for(urls: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """The pages whose URL occurs in ``urls``; null and empty URLs have none.

    Up to ``LOOKUP_URLS`` distinct URLs are named to the scan. Of a table of ``write_pages``, which
    tells the number of its folders itself, only their folders are listed and read, and in these
    only row groups whose statistics and Bloom filter can hold one of them. More URLs are broadcast
    while they measure small, and the folders still pruned by what was broadcast; beyond that both
    sides meet by a shuffle on the URL.
    """
    wanted = urls.select(url).where(F.col(url) > "").distinct()
    buckets = bucket_count(pages)
    on = [url]
    if buckets is not None:
        wanted = wanted.withColumn("url_bucket", page_bucket(F.col(url), buckets))
        on = ["url_bucket", url]
    wanted = settle(wanted, "wanted")
    named = wanted.limit(LOOKUP_URLS + 1).collect()
    if len(named) <= LOOKUP_URLS:
        asked = F.lit(True)
        for column in on:
            asked = asked & F.col(column).isin(sorted({row[column] for row in named}))
        return pages.where(asked).drop("url_bucket")
    small = broadcast_if_small(wanted)
    return pages.join(small.where(F.col(url) > ""), on, "left_semi").drop("url_bucket")


def spread(scan: DataFrame) -> DataFrame:
    """A freshly read frame over all cores, for costly work per row.

    Only an input of fewer splits than cores is shuffled; a large one passes as it is. Select the
    columns needed first, and do not use it where the order of the files matters.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
