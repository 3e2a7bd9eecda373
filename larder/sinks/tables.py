"""Table, list, document and message sinks."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.text import json_filename
from larder.operators.index import head_rows, with_shard
from larder.sources.tables import page_bucket


def dataset_path(path: str, spec: str) -> str:
    """Folder of one dataset's rows."""
    return f"{path}/spec={quote(spec, safe=' ')}"


def write_dataset(df: DataFrame, path: str, spec: str) -> None:
    """One dataset's rows under ``spec=<name>``; they replace its earlier ones, also by no rows."""
    df.drop("spec").write.mode("overwrite").parquet(dataset_path(path, spec))


def write_table(df: DataFrame, path: str, csv: bool = False) -> None:
    """A master table or vocabulary, as parquet or CSV."""
    writer = df.write.mode("overwrite")
    if csv:
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.parquet(path)


def write_head(
    df: DataFrame, path: str, key: str, n: int, then: Sequence[str] = (), csv: bool = False
) -> None:
    """The first ``n`` rows in key order."""
    write_table(head_rows(df, key, n, then), path, csv)


def url_list(df: DataFrame) -> DataFrame:
    return df.select("uid", "url")


def write_url_list(df: DataFrame, path: str) -> None:
    write_table(url_list(df), path, csv=True)


def json_documents(df: DataFrame) -> DataFrame:
    """``json_filename, doc`` per row. Documents stay lines of a table, not a file each."""
    name = json_filename(F.col("dish_id"), F.col("source"))
    doc = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(name.alias("json_filename"), doc.alias("doc"))


def write_json_documents(df: DataFrame, path: str) -> None:
    json_documents(df).write.mode("overwrite").json(path)


def write_shards(df: DataFrame, path: str, idx: str, rows_per_shard: int) -> None:
    """JSON Lines in folders ``shard=<i>`` of ``rows_per_shard`` rows each."""
    sharded = with_shard(df, idx, rows_per_shard)
    sharded.repartition("shard").write.mode("overwrite").partitionBy("shard").json(path)


def messages(df: DataFrame, key: str) -> DataFrame:
    """Each row as a JSON message, ``key, value`` as a queue writer takes them."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value")
    )


def write_messages(df: DataFrame, path: str, key: str) -> None:
    messages(df, key).write.mode("append").json(path)


def write_pages(
    pages: DataFrame,
    path: str,
    buckets: int,
    url: str = "url",
    row_group_bytes: int = 32 << 20,
) -> None:
    """Pages laid out for lookups by URL, see ``pages_for``.

    They lie in folders by a hash of the URL, sorted by URL in every file, with a Bloom filter on it
    for each row group, so a lookup opens few folders, in them few row groups and in these few
    pages of the file. The folder names tell how many folders there are. Pages are dealt out by
    folder first, so a folder gets a few files, not one of every task; a folder of very many pages
    is split by the rebalancing. Pages without a URL are kept but never found.
    """
    bucketed = pages.withColumn("url_bucket", page_bucket(F.col(url), buckets))
    dealt = bucketed.hint("rebalance", "url_bucket").sortWithinPartitions("url_bucket", url)
    (
        dealt.write.mode("overwrite")
        .partitionBy("url_bucket")
        .option(f"parquet.bloom.filter.enabled#{url}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        # Without a dictionary, which would stand in for the filter, the filter is always written.
        .option(f"parquet.enable.dictionary#{url}", "false")
        .option("parquet.block.size", str(row_group_bytes))
        .parquet(path)
    )
