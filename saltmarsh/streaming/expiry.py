"""Keyed stream state that expires, kept in a table of generations.

A key that is unseen for longer than its lifetime starts anew.  Time is the
event time of the rows, so a replay gives the same result.  Each micro-batch
reads the live state once and writes the state of its own keys; every
``fold_every`` batches the changes are folded into a new generation, and keys
that have expired by then are left out of it.  So a batch reads one generation
and a bounded number of changes, and the state holds live keys only.  All names
derive from the batch number, so a batch that runs again overwrites its own
files and reads what it read before.  Everything stays in the JVM: keys are cut
into time slices, so one key may hold any share of a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from saltmarsh.operators.sequences import ordered_columns, time_slice

FOLD_EVERY = 16


class Generations:
    """State rows (``_key``, ``_last``, ``_kept``) after each batch: a full generation and the changes after it."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, lifetime: str, fold_every: int = FOLD_EVERY) -> None:
        self.spark, self.path, self.schema, self.lifetime, self.fold_every = spark, path, schema, lifetime, fold_every

    def _generation(self, batch: int) -> int:
        """Number of the last batch that is part of the generation a batch reads; -1 before the first fold."""
        return batch // self.fold_every * self.fold_every - 1

    def _read(self, upto: int, changes: Sequence[int]) -> DataFrame:
        places = [f"{self.path}/generation-{upto}"] if upto >= 0 else []
        places += [f"{self.path}/change-{n}" for n in changes]
        if not places:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*places)
        newest = F.max_by(F.struct("_last", "_kept"), F.col("_batch"))
        return rows.groupBy("_key").agg(newest.alias("_s"), F.max("_batch").alias("_batch")).select("_key", "_s._last", "_s._kept", "_batch")

    def before(self, batch: int) -> DataFrame:
        """The state that a batch starts with; at the turn of a generation this writes the new one first."""
        upto = self._generation(batch)
        if batch and batch % self.fold_every == 0:
            older = self._generation(batch - 1)
            rows = self._read(older, range(older + 1, batch))
            newest = rows.agg(F.max("_last")).first()[0]  # one value: the time up to which the stream has come
            alive = rows if newest is None else rows.filter(F.col("_last") + F.expr(f"INTERVAL {self.lifetime}") >= F.lit(newest))
            alive.write.mode("overwrite").parquet(f"{self.path}/generation-{upto}")
        return self._read(upto, range(upto + 1, batch))

    def write(self, state: DataFrame, batch: int) -> None:
        state.withColumn("_batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{self.path}/change-{batch}")


def lives(
    batch: DataFrame, state: DataFrame, key: str, order: Sequence[str], ts: str, lifetime: str, slice_by: Column
) -> DataFrame:
    """Rows with ``_life``: 0 while the stored life of their key goes on, then 1, 2, ... for each start anew; with ``_last`` and ``_kept``.

    A row starts a life if no row of its key came before, or the newest of them
    is older than ``lifetime``.  A row that is older than the stored state
    belongs to the stored life.
    """
    earlier = ordered_columns(batch, [key], order, slice_by, max_before={"_before": ts})
    known = earlier.join(state.drop("_batch"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    newest = F.greatest("_before", "_last")
    starts = newest.isNull() | (F.col(ts) > newest + F.expr(f"INTERVAL {lifetime}"))
    marked = known.withColumn("_start", F.when(starts, 1).otherwise(0)).drop("_before")
    return ordered_columns(marked, [key], order, slice_by, running_sum={"_life": "_start"})


def _state_schema(df: DataFrame, key: str, ts: str, kept: Column) -> StructType:
    return df.limit(0).select(F.col(key).alias("_key"), F.col(ts).alias("_last"), kept.alias("_kept"), F.lit(0).cast("long").alias("_batch")).schema


def _run(df: DataFrame, path: str, checkpoint: str, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], schema: StructType,
         lifetime: str, fold_every: int) -> StreamingQuery:
    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            state = Generations(batch.sparkSession, f"{path}/state", schema, lifetime, fold_every)
            out, after = step(batch, state.before(batch_id))
            state.write(after, batch_id)
            out.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_value_stream(
    df: DataFrame, path: str, checkpoint: str, key: str, order: Sequence[str], ts: str, kept: Column, flag: Callable[[Column], Column],
    name: str, lifetime: str = "7 DAYS", slice_width: str = "day", fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Flag rows by the first value of the running life of their key; rows and flags go to ``<path>/out``.

    ``order`` begins with ``ts`` and is unique per row.  Null keys are a key.
    """
    columns, slice_by = df.columns, time_slice(F.col(ts), slice_width)

    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = lives(batch, state, key, order, ts, lifetime, slice_by)
        rows = rows.withColumn("_own", F.when(F.col("_start") == 1, F.struct(kept.alias("v"))))
        rows = ordered_columns(rows, [key], order, slice_by, carried={"_now": "_own"})
        first = F.when(F.col("_life") == 0, F.col("_kept")).otherwise(F.col("_now")["v"])
        rows = rows.withColumn("_first", first)
        after = rows.groupBy(F.col(key).alias("_key")).agg(
            F.greatest(F.max(ts), F.max("_last")).alias("_last"), F.max_by("_first", F.struct(*order)).alias("_kept"))
        return rows.select(*columns, flag(F.col("_first")).alias(name)), after

    return _run(df, path, checkpoint, step, _state_schema(df, key, ts, kept), lifetime, fold_every)


def newer_only_stream(
    df: DataFrame, path: str, checkpoint: str, key: str, order: Sequence[str], ts: str, measure: str, lifetime: str = "1 DAY",
    slice_width: str = "hour", fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Rows whose ``measure`` is above every earlier one of the running life of their key; written to ``<path>/out``."""
    columns, slice_by = df.columns, time_slice(F.col(ts), slice_width)

    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = lives(batch, state, key, order, ts, lifetime, slice_by)
        rows = ordered_columns(rows, [key, "_life"], order, slice_by, max_before={"_seen": measure})
        limit = F.when(F.col("_life") == 0, F.greatest("_seen", "_kept")).otherwise(F.col("_seen"))
        top = F.greatest(F.max(measure), F.max(F.when(F.col("_life") == 0, F.col("_kept"))))
        tops = rows.groupBy(key, "_life").agg(F.max(ts).alias("_t"), F.max("_last").alias("_l"), top.alias("_top"))
        after = tops.groupBy(F.col(key).alias("_key")).agg(
            F.greatest(F.max("_t"), F.max("_l")).alias("_last"), F.max_by("_top", "_life").alias("_kept"))
        return rows.filter(limit.isNull() | (F.col(measure) > limit)).select(*columns), after

    return _run(df, path, checkpoint, step, _state_schema(df, key, ts, F.col(measure)), lifetime, fold_every)
