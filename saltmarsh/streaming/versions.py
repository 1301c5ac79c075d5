"""Keyed tables written batch by batch, folded from time to time behind a manifest.

A table is a folder with one ``batch_id=<n>`` directory per micro-batch.  A fold
writes the current row of every key over the last fold and the batches after it
to a directory of its own, and then one manifest row that names this directory
and the last batch in it.  The manifest row is a single committed file, so a
reader sees either the old fold with all later batches or the new one with
fewer of them, never a mixture.  A fold that broke off before its manifest row
is written again by the next one; a fold without new batches does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "version long, upto long, fold string"


class Version(NamedTuple):
    number: int
    upto: int
    fold: str | None


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _files(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _files(spark, path)
    system.delete(place, True)


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the written batches: names of directories, not rows."""
    system, place = _files(spark, path)
    if not system.exists(place):
        return []
    names = [s.getPath().getName() for s in system.listStatus(place)]
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def current_version(spark: SparkSession, path: str) -> Version:
    """The manifest row with the greatest number; version 0, with all batches after it, without a fold."""
    if not exists(spark, f"{path}-folds/manifest"):
        return Version(0, -2, None)
    rows = spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{path}-folds/manifest")
    last = rows.orderBy(F.col("version").desc()).first()
    return Version(last["version"], last["upto"], last["fold"]) if last else Version(0, -2, None)


def all_rows(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Rows of the current fold (``batch_id`` as folded: -1) and of the batches after it."""
    version = current_version(spark, path)
    later = [n for n in batch_numbers(spark, path) if n > version.upto]
    parts: list[DataFrame] = []
    if version.fold:
        parts.append(spark.read.parquet(version.fold).withColumn("batch_id", F.lit(-1).cast("long")))
    if later:
        reader = spark.read if schema is None else spark.read.schema(schema)
        batches = reader.option("basePath", path).parquet(*[f"{path}/batch_id={n}" for n in later])
        parts.append(batches.withColumn("batch_id", F.col("batch_id").cast("long")))
    if not parts:
        raise ValueError(f"no batch has been written to {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fold(spark: SparkSession, path: str, current: Callable[[DataFrame], DataFrame], upto: int | None = None) -> Version:
    """Fold all batches (or those up to ``upto``) with ``current``, which reduces rows to one per key in the same columns."""
    version = current_version(spark, path)
    waiting = [n for n in batch_numbers(spark, path) if n > version.upto and (upto is None or n <= upto)]
    if not waiting:
        return version
    rows = all_rows(spark, path).filter(F.col("batch_id") <= waiting[-1])
    made = Version(version.number + 1, waiting[-1], f"{path}-folds/fold-{version.number + 1:06d}")
    current(rows).drop("batch_id").write.mode("overwrite").parquet(made.fold)
    row = spark.createDataFrame([tuple(made)], MANIFEST).coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}-folds/manifest/version-{made.number:06d}")
    return made


def remove_folded(spark: SparkSession, path: str) -> None:
    """Delete batches and folds that the current version has taken over; for a time when no reader uses an older version."""
    version = current_version(spark, path)
    for n in batch_numbers(spark, path):
        if n <= version.upto:
            remove(spark, f"{path}/batch_id={n}")
    for n in range(1, version.number):
        remove(spark, f"{path}-folds/fold-{n:06d}")
