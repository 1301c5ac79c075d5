"""Session settings shared by batch and streaming jobs."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app_name: str = "saltmarsh",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session with the settings every operator here assumes.

    UTC keeps date columns independent of the machine, ANSI mode turns bad
    casts into errors instead of silent nulls, and adaptive execution picks the
    join type and splits skewed partitions from measured sizes.  Generated
    methods above 8000 bytecodes would run interpreted (the JVM does not compile
    them), so wide projections fall back to code split by expression.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame written once to the cluster's checkpoint folder and read from there.

    For a frame that several branches of a plan use: its inputs are computed
    once, and a lost executor costs a re-read instead of a re-computation.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoint"))
    return df.checkpoint()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's checkpoint directory.

    The cluster names a folder every executor can reach in
    ``spark.checkpoint.dir``.  When that is unset, only a session that runs on
    one machine gets a temporary folder; on a cluster it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="saltmarsh-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4()}"


def stored(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """The frame written once as a table in the shared folder and read from there.

    The shuffle files of the write go when it has ended, as nothing reads them again.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(folder, compression=codec)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)
