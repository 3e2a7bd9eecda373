"""Raw dataset files ``raw_dataset_<spec>.csv`` and their row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.sets import not_yet
from larder.operators.sizes import broadcast_if_small
from larder.schemas import RAW_CORPUS
from larder.session import settle

_SPEC = r"raw_dataset_([^/]+)\.csv(?:/[^/]*)?$"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    multi_line: bool = True,
    files: str = "*.csv",
) -> DataFrame:
    """CSV with doubled quotes; only a blank field is null.

    A file with line breaks inside fields is one task's read, see ``read_large_csv`` for others.
    ``multi_line=False`` splits files that have none.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", "true")
        .option("pathGlobFilter", files)
        .csv(path)
    )


_LINE = ["_file", "_block"]


def quoted_records(
    spark: SparkSession, path: str | list[str], files: str = "*.csv"
) -> DataFrame:
    """``_file, _block, _record, text``: the records of CSV files, read by many tasks a file.

    A record ends at a line break outside quotes; doubled quotes change nothing, as they are two.
    The lines of a split are read from its beginning, wherever that lies. Whether it lies inside
    quotes is told by the parity of all quotes before it: each split adds up its own, and the sums
    are scanned over the splits of a file. Lines before a split's first record belong to the last
    record before it. ``_record`` counts the records of a split from 1.
    """
    read = spark.read.option("lineSep", "\n").option("pathGlobFilter", files).text(path)
    lines = settle(
        read.select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_mid"),
        ),
        "lines",
    )
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    sums = lines.groupBy(*_LINE).agg((F.sum(quotes) % 2).alias("_odd"))
    splits = Window.partitionBy("_file").orderBy("_block")
    earlier = splits.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2
    entry = broadcast_if_small(settle(sums.select(*_LINE, inside.alias("_inside")), "parities"))
    # A window holds the lines of one split of the input, whose size is bounded.
    place = Window.partitionBy(*_LINE).orderBy("_mid")
    before = F.sum(quotes).over(place.rowsBetween(Window.unboundedPreceding, -1))
    outside = (F.coalesce(before, F.lit(0)) + F.col("_inside")) % 2 == 0
    marked = lines.join(entry, _LINE).withColumn("_begins", outside.cast("int"))
    counted = marked.withColumn("_record", F.sum("_begins").over(place))
    ordered = F.array_sort(F.collect_list(F.struct("_mid", "value")))
    text = F.array_join(F.transform(ordered, lambda line: line["value"]), "\n").alias("text")
    parts = settle(counted.groupBy(*_LINE, "_record").agg(text), "record-parts")

    last = parts.groupBy(*_LINE).agg(F.max("_record").alias("_last"))
    known = F.when(F.col("_last") > 0, F.struct(F.col("_block").alias("b"), F.col("_last").alias("r")))
    owners = last.select(*_LINE, F.last(known, ignorenulls=True).over(earlier).alias("_owner"))
    owners = broadcast_if_small(settle(owners, "owners"))
    late = parts.where("_record = 0").join(owners, _LINE)
    pieces = F.array_sort(F.collect_list(F.struct("_block", "text")))
    tails = late.groupBy(
        "_file", F.col("_owner.b").alias("_block"), F.col("_owner.r").alias("_record")
    ).agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("_tail"))
    whole = parts.where("_record > 0").join(tails, [*_LINE, "_record"], "left")
    joined = F.concat_ws("\n", "text", "_tail")
    return whole.select(*_LINE, "_record", F.regexp_replace(joined, "\r$", "").alias("text"))


def read_large_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    files: str = "*.csv",
) -> DataFrame:
    """The rows of ``read_csv``, each file read by many tasks; ``_file, _block, _mid`` place them.

    The first record of each file is its header; empty records are no rows.
    """
    records = quoted_records(spark, path, files)
    if header:
        records = records.where((F.col("_block") != 0) | (F.col("_record") != 1))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("text", fields, {"escape": '"'})
    in_split = Window.partitionBy(*_LINE).orderBy("_record")
    return records.where("text <> ''").select(
        row.alias("_row"), *_LINE, F.row_number().over(in_split).cast("bigint").alias("_mid")
    ).select("_row.*", *_LINE, "_mid")


#: Files of more bytes are read by many tasks.
LARGE_BYTES = 256 << 20


def _largest_file(spark: SparkSession, path: str | list[str], files: str) -> int:
    """Bytes of the largest file; the files are listed, not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", files).load(path)
    return listed.agg(F.max("length")).first()[0] or 0


def spec_of(path: Column) -> Column:
    """Dataset name in the path of a raw file, or of a part file in a folder of that name."""
    return F.regexp_extract(path, _SPEC, 1)


def raw_path(directory: str, spec: str) -> str:
    return f"{directory}/raw_dataset_{spec}.csv"


def discover_specs(spark: SparkSession, directory: str) -> DataFrame:
    """The distinct ``spec`` of the raw datasets in a folder. File contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    )
    return listed.select(spec_of(F.col("path")).alias("spec")).where("spec != ''").distinct()


def unprocessed(specs: DataFrame, done: DataFrame | None, reprocess: bool = False) -> DataFrame:
    """Specs to work on: all, or those without an entry in ``done``."""
    if reprocess or done is None:
        return specs
    return not_yet(specs, done, "spec")


def land_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_CORPUS,
    multi_line: bool = True,
    files: str = "*.csv",
    large: int = LARGE_BYTES,
) -> DataFrame:
    """Read raw CSV once, as a splittable copy in the shared folder, with its row order.

    Adds ``spec`` and ``n``, the row's position in its dataset. Where fields may hold line breaks
    and a file has more than ``large`` bytes, the files are read by many tasks each, with the same
    rows and positions.
    """
    if multi_line and _largest_file(spark, path, files) > large:
        raw = read_large_csv(spark, path, schema, files=files)
    else:
        raw = read_csv(spark, path, schema, multi_line=multi_line, files=files).select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_mid"),
        )
    landed = settle(raw.withColumn("spec", spec_of(F.col("_file"))), "raw")
    return file_positions(landed).drop("_file", "_block", "_mid")


def file_positions(landed: DataFrame, name: str = "n") -> DataFrame:
    """Position of each row in its dataset, files in name order, without moving a row.

    A task numbers the rows of an input split consecutively, so a row's place in its split is its
    number minus the split's smallest. Splits before it in the dataset add their row counts; that
    table has one row per split and is broadcast if it measures small.
    """
    splits = landed.groupBy("spec", "_file", "_block").agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = (
        Window.partitionBy("spec")
        .orderBy("_file", "_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = splits.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    position = F.col("_start") + F.col("_mid") - F.col("_first")
    starts = broadcast_if_small(settle(starts, "splits"))
    return (
        landed.join(starts, ["_file", "_block"])
        .withColumn(name, position.cast("bigint"))
        .drop("_first", "_start")
    )


def parquet_positions(spark: SparkSession, path: str | list[str], name: str = "idx") -> DataFrame:
    """Rows of parquet files with their position over all files, in file name order.

    The reader knows each row's place in its file, so only row counts per file are added.
    """
    rows = spark.read.parquet(*([path] if isinstance(path, str) else path))
    located = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    totals = located.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    starts = broadcast_if_small(settle(starts, "files"))
    return located.join(starts, "_file").select(
        *rows.columns, (F.col("_start") + F.col("_row")).cast("bigint").alias(name)
    )
