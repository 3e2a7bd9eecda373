"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "larder") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is made only for a local master that names none.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="larder-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for one run under the shared folder."""
    return f"{shared_dir(spark)}/larder/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage before a frame is used several times; the copy survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_by(df: DataFrame, key: str, label: str = "settled") -> DataFrame:
    """Like ``settle``, with the rows in buckets of ``key``, as many as a shuffle has partitions.

    A join or anti-join on the key reads such a table where it lies; only the other side moves.
    The frame's rows are moved to their buckets first, unless they come that way, so every bucket
    is one sorted file.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"larder_{label.replace('-', '_')}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    writer = dealt.write.format("parquet").option("path", scratch_path(spark, label))
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keep the state of streams in RocksDB, whose size is not bound by memory.

    Timers need it. To be set before a query starts; one restarted keeps to its checkpoint's store.
    """
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
