"""Queue messages and object events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.sets import already, not_yet
from larder.schemas import CHUNK_MANIFEST, OBJECT_EVENT, QUEUE_MESSAGE, SCRAPED, URL_LIST
from larder.sources.corpus import read_csv


def decode_body(df: DataFrame, schema: T.StructType, body: str = "body") -> DataFrame:
    """The JSON body's fields as columns; ``unreadable`` marks a body that is no JSON object."""
    read = df.withColumn("_read", F.from_json(body, schema))
    # The parser stops at the end of the first value, so what follows it is looked at here.
    framed = F.coalesce(F.col(body).rlike(r"(?s)^\s*\{.*\}\s*$"), F.lit(False))
    unreadable = ~framed | F.try_parse_json(body).isNull()
    return read.select(*df.columns, "_read.*", unreadable.alias("unreadable"))


def url_messages(df: DataFrame) -> DataFrame:
    return decode_body(df, URL_LIST)


def chunk_messages(df: DataFrame) -> DataFrame:
    return decode_body(df, CHUNK_MANIFEST)


def object_events(df: DataFrame, body: str = "body") -> DataFrame:
    """Bucket and key of the first record of an object-created event."""
    first = F.get(F.from_json(body, OBJECT_EVENT)["Records"], 0)["s3"]
    return df.select(
        *df.columns,
        first["bucket"]["name"].alias("bucket"),
        first["object"]["key"].alias("object_key"),
    )


def read_messages(spark: SparkSession, path: str, schema: T.StructType = QUEUE_MESSAGE) -> DataFrame:
    """JSON Lines messages; a key a message lacks is null."""
    return spark.read.schema(schema).json(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType = SCRAPED) -> DataFrame:
    """JSON Lines records as a table; a key a record lacks is null."""
    return spark.read.schema(schema).json(path)


def read_json_objects(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per file, kept whole as VARIANT: ``path, record``."""
    texts = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return texts.select(
        F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("record")
    )


def event_files(
    spark: SparkSession, events: DataFrame, directory: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Rows of the CSV files the events name, and the events whose file is not there.

    ``events`` carry ``object_key``, a path below ``directory``. The folder is listed, not read;
    only the names of this batch's files come to the driver, which plans the read from them.
    """
    root = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = root.load(directory).select("path")
    keyed = files.withColumn("object_key", F.substring_index("path", f"{directory.rstrip('/')}/", -1))
    found = already(keyed, events.where(F.col("object_key").endswith(".csv")), "object_key")
    paths = [row["path"] for row in found.select("path").collect()]
    rows = (
        read_csv(spark, paths, schema).withColumn("file", F.col("_metadata.file_path"))
        if paths
        else spark.createDataFrame([], schema).withColumn("file", F.lit(None).cast("string"))
    )
    return rows, not_yet(events, keyed, "object_key")
