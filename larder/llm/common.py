"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch handed to a Python worker; a batch holds at least one row.
BATCH_BYTES = 16 << 20
BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches by bytes, as texts differ much in length."""
    spark.conf.set(BYTES_CONF, str(most))


def text_or_empty(text: str) -> Column:
    """The text column as a string, null as the empty text."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def over_cores(df: DataFrame) -> DataFrame:
    """A freshly read frame over at least all cores; a large one passes as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
