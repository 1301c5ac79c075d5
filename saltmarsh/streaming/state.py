"""Keyed state: new-visitor repair, first logins, latest-only, profiles, snapshot end.

Each rule comes in two forms.  The batch form uses aggregations and joins only.
Stream forms named ``*_table`` keep the state in a table and stay in the JVM, so
a key may hold any share of a micro-batch.  The other stream forms keep one
small state per key; there the rows of a key within one micro-batch are bounded
by the source's rows- or files-per-trigger setting.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from saltmarsh.operators.sequences import ordered_columns
from saltmarsh.streaming.inputs import AVAILABLE_NOW

NO_TIMEOUT = GroupStateTimeout.NoTimeout


def _schema(df: DataFrame, extra: str) -> StructType:
    return StructType([*df.schema.fields, *StructType.fromDDL(extra).fields])


def _in_order(frames, order: str) -> pd.DataFrame:
    """All rows of a key in this micro-batch, by the order column."""
    return pd.concat(list(frames), ignore_index=True).sort_values(order, kind="stable")


# -- new-visitor repair ---------------------------------------------------------


def first_visit(df: DataFrame, key: str, order: Sequence[str], day: Column, is_new: Column) -> DataFrame:
    """State of each key: the day of a first "new" record, the day before a first "old" one."""
    kept = F.when(is_new == "1", day).otherwise(F.date_sub(day, 1))
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(kept, F.struct(*order)).alias("_state"))


def repair_new_flag(df: DataFrame, key: str, order: Sequence[str], ts: str, flag: str) -> DataFrame:
    """``is_new`` corrected to 0 on any day other than the stored first day."""
    day = F.to_date(ts)
    state = first_visit(df, key, order, day, F.col(flag))
    fixed = F.when((F.col(flag) == "1") & (day != F.col("_state")), F.lit("0")).otherwise(F.col(flag))
    return df.join(state, F.col(key).eqNullSafe(F.col("_key"))).select(*df.columns, fixed.alias("fixed_" + flag))


def repair_new_flag_stream(df: DataFrame, key: str, ts: str, flag: str, ttl_ms: int | None = None) -> DataFrame:
    """Stream form; ``ttl_ms`` forgets a key after that long without records."""

    def step(k, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = _in_order(frames, ts)
        day = pd.to_datetime(rows[ts]).dt.floor("D")
        if state.exists:
            first = pd.Timestamp(state.get[0])
        else:
            head = rows.iloc[0]
            first = day.iloc[0] if head[flag] == "1" else day.iloc[0] - pd.Timedelta(days=1)
            state.update((first.strftime("%Y-%m-%d"),))
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)
        fixed = rows[flag].where(~((rows[flag] == "1") & (day != first)), "0")
        yield rows.assign(**{"fixed_" + flag: fixed})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else NO_TIMEOUT
    return df.groupBy(key).applyInPandasWithState(
        step, _schema(df, f"fixed_{flag} string"), "first_day string", "append", timeout
    )


# -- first logins and first-seen flags ------------------------------------------


def first_login_flag(df: DataFrame, user: str, day: str, name: str = "is_first") -> DataFrame:
    """1 on the user's first day, else 0."""
    first = df.groupBy(F.col(user).alias("_u")).agg(F.min(day).alias("_first"))
    flag = F.when(F.col(day) == F.col("_first"), 1).otherwise(0)
    return df.join(first, F.col(user).eqNullSafe(F.col("_u"))).select(*df.columns, flag.alias(name))


def login_counts(df: DataFrame, user: str, day: str) -> DataFrame:
    """Logins per day and first-day flag."""
    return first_login_flag(df, user, day).groupBy(day, "is_first").agg(F.count(F.lit(1)).alias("login_count"))


def first_login_stream(df: DataFrame, user: str, ts: str, name: str = "is_first") -> DataFrame:
    def step(k, frames, state):
        rows = _in_order(frames, ts)
        days = pd.to_datetime(rows[ts]).dt.strftime("%Y-%m-%d")
        first = state.get[0] if state.exists else days.iloc[0]
        if not state.exists:
            state.update((first,))
        yield rows.assign(**{name: (days == first).astype("int32")})

    return df.groupBy(user).applyInPandasWithState(
        step, _schema(df, f"{name} int"), "first_day string", "append", NO_TIMEOUT
    )


def first_seen_flag(df: DataFrame, visitor: str, order: Sequence[str], name: str = "is_new_visitor") -> DataFrame:
    """1 for the very first row of each visitor, else 0; ``order`` is unique per row."""
    first = df.groupBy(F.col(visitor).alias("_v")).agg(F.min(F.struct(*order)).alias("_first"))
    flag = F.when(F.struct(*order) == F.col("_first"), 1).otherwise(0)
    return df.join(first, F.col(visitor).eqNullSafe(F.col("_v"))).select(*df.columns, flag.alias(name))


def first_seen_stream(df: DataFrame, visitor: str, ts: str, name: str = "is_new_visitor") -> DataFrame:
    def step(k, frames, state):
        rows = _in_order(frames, ts)
        flags = [0] * len(rows)
        if not state.exists:
            flags[0] = 1
            state.update((True,))
        yield rows.assign(**{name: pd.Series(flags, index=rows.index, dtype="int32")})

    return df.groupBy(visitor).applyInPandasWithState(step, _schema(df, f"{name} int"), "seen boolean", "append", NO_TIMEOUT)


# -- latest-only filter -----------------------------------------------------------


def newer_only_stream(df: DataFrame, key: str, arrival: str, ts: str, ttl_ms: int | None = None) -> DataFrame:
    """Emit a row only if it is newer than every earlier row of its key."""

    def step(k, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        rows = _in_order(frames, arrival)
        seen = state.get[0] if state.exists else None
        values = rows[ts].astype("int64")
        before = values.cummax().shift(1)
        if seen is not None:
            before = before.fillna(seen).clip(lower=seen)
        keep = before.isna() | (values > before)
        top = int(values.max())
        state.update((top if seen is None else max(seen, top),))
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)
        yield rows[keep]

    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else NO_TIMEOUT
    return df.groupBy(key).applyInPandasWithState(step, df.schema, "seen bigint", "append", timeout)


# -- running profile ----------------------------------------------------------------


def _first_sights(df: DataFrame, user: str, at: Column, fields: Sequence[str]) -> DataFrame:
    """``_u``, ``_tag`` (a field), ``_f`` (a value as text) and ``_first``: where each user first shows each value.

    All fields are told in one pass over the rows and combined before the shuffle.
    """
    told = F.explode(F.array(*[F.struct(F.lit(f).alias("tag"), F.col(f).cast("string").alias("f")) for f in fields]))
    return (
        df.select(F.col(user).alias("_u"), at.alias("_at"), told.alias("_t")).filter("_t.f IS NOT NULL")
        .groupBy("_u", F.col("_t.tag").alias("_tag"), F.col("_t.f").alias("_f")).agg(F.min("_at").alias("_first"))
    )


def running_profile(df: DataFrame, user: str, order: Sequence[str], fields: Sequence[str], slice_by: Column) -> DataFrame:
    """Page-view counter and number of distinct values so far per field.

    A value counts from its first row on, so the growing size of a set is the
    running sum of first sights; the sets themselves are not copied into every
    row.  The first sights of all fields are counted per user and place, and
    meet the rows in one join.
    """
    sights = _first_sights(df, user, F.struct(*order), fields).groupBy("_u", "_first").agg(
        *[F.count(F.when(F.col("_tag") == f, 1)).alias(f"_new_{f}") for f in fields]
    )
    same = F.col(user).eqNullSafe(F.col("_u")) & (F.struct(*order).eqNullSafe(F.col("_first")))
    marked = df.join(sights, same, "left").select(
        *[df[c] for c in df.columns], *[F.coalesce(f"_new_{f}", F.lit(0)).alias(f"_new_{f}") for f in fields]
    )
    counted = ordered_columns(
        marked, [user], order, slice_by, row_number="pv", running_sum={f"{f}_count": f"_new_{f}" for f in fields}
    )
    return counted.select(*df.columns, "pv", *[f"{f}_count" for f in fields])


def latest_profile(df: DataFrame, user: str, ts: str, fields: Sequence[str]) -> DataFrame:
    """Final state of the profile: views, last time and the value list per field, in one pass.

    Meant for fields with few distinct values (device, channel, system): the
    sets are combined before the shuffle.  A list without a value is null.
    """
    sets = [F.collect_set(F.col(f).cast("string")) for f in fields]
    lists = [F.when(F.size(s) > 0, F.array_join(F.sort_array(s), ",")).alias(f"{f}_list") for s, f in zip(sets, fields)]
    return df.groupBy(user).agg(F.count(F.lit(1)).alias("pv"), F.max(ts).alias("last_ts"), *lists)


def running_profile_lists(df: DataFrame, user: str, order: Sequence[str], ts: str, fields: Sequence[str], slice_by: Column) -> DataFrame:
    """Page-view counter and sorted list of the distinct values so far per field, over all rows kept of a stream.

    The order is that of the rows, not of their arrival.  A value counts from
    the time of its first sight on; a list without a value is null.  Meant for
    fields with few distinct values: each user has one row with the first sights
    of all fields.
    """
    out = ordered_columns(df, [user], order, slice_by, row_number="pv")
    lists = _first_sights(df, user, F.col(ts), fields).groupBy("_u").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("_tag") == f, F.struct("_f", "_first")))).alias(f"_s_{f}") for f in fields]
    )

    def seen(f: str) -> Column:
        values = F.transform(F.filter(f"_s_{f}", lambda s: s["_first"] <= F.col(ts)), lambda s: s["_f"])
        return F.when(F.size(values) > 0, F.array_join(values, ",")).alias(f"{f}_list")

    return out.join(lists, F.col(user).eqNullSafe(F.col("_u")), "left").select(*out.columns, *map(seen, fields))


def running_profile_stream(df: DataFrame, user: str, ts: str, fields: Sequence[str]) -> DataFrame:
    """Stream form with the joined value lists, as one state per user, for rows that arrive in the order of ``ts``."""
    names = list(fields)
    extra = "pv bigint, " + ", ".join(f"{f}_list string" for f in names)

    def step(k, frames, state):
        rows = _in_order(frames, ts)
        pv, text = state.get if state.exists else (0, "{}")
        sets = {f: list(v) for f, v in json.loads(text).items()}
        lists: dict[str, list[str]] = {f: [] for f in names}
        for values in rows[names].itertuples(index=False):
            for f, v in zip(names, values):
                have = sets.setdefault(f, [])
                if v is not None and v == v and str(v) not in have:
                    have.append(str(v))
                lists[f].append(",".join(sorted(have)))
        out = rows.assign(pv=range(pv + 1, pv + 1 + len(rows)), **{f"{f}_list": lists[f] for f in names})
        state.update((pv + len(rows), json.dumps(sets)))
        yield out

    return df.groupBy(user).applyInPandasWithState(step, _schema(df, extra), "pv bigint, sets string", "append", NO_TIMEOUT)


# -- end of the initial snapshot ------------------------------------------------------


def snapshot_rows_stream(df: DataFrame, key: str, idle_ms: int | None = 15_000) -> DataFrame:
    """Pass snapshot rows and add one marker row when the snapshot of a key is over.

    It is over at the first other row, or when no row came for ``idle_ms``.  The
    idle timer needs a running query (processing-time trigger); without it a
    run over the available files ends by itself.
    Needs columns ``op`` and ``is_snapshot``; the marker has ``completed = true``
    and nulls elsewhere.
    """
    schema = _schema(df, "completed boolean")
    columns = df.columns

    def marker(k) -> pd.DataFrame:
        row = {c: [None] for c in columns}
        row[key] = [k[0]]
        return pd.DataFrame({**row, "completed": [True]})

    def step(k, frames, state):
        done = state.exists and state.get[0]
        if state.hasTimedOut:
            state.update((True,))
            if not done:
                yield marker(k)
            return
        ended = False
        for frame in frames:
            inside = (frame["op"] == "r") | (frame["is_snapshot"] == "true")
            ended = ended or bool((~inside).any())
            passed = frame[inside]
            if len(passed):
                yield passed.assign(completed=False)
        state.update((bool(done or ended),))
        if ended and not done:
            yield marker(k)
        if idle_ms and not (done or ended):
            state.setTimeoutDuration(idle_ms)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else NO_TIMEOUT
    return df.groupBy(key).applyInPandasWithState(step, schema, "done boolean", "append", timeout)


def run_until_idle(df: DataFrame, path: str, checkpoint: str, idle_ms: int, interval: str = "500 milliseconds") -> None:
    """Run a stream with idle timers into ``path`` until it has read all files and every timer has had its time.

    Timers fire in micro-batches without rows; the run ends with one that began
    ``idle_ms`` or more after the last micro-batch with rows had ended.  (With
    timers there always is another micro-batch, so ``processAllAvailable`` would wait for ever.)
    """
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    query = writer.trigger(processingTime=interval).start()
    try:
        while not query.awaitTermination(1):  # raises if the query failed
            read_until, idle_from = 0.0, []
            for report in (json.loads(p.json) for p in query.recentProgress):
                began = datetime.fromisoformat(report["timestamp"].replace("Z", "+00:00")).timestamp()
                if report["numInputRows"]:
                    read_until = began + report["durationMs"]["triggerExecution"] / 1000
                else:
                    idle_from.append(began)
            if any(t >= read_until + idle_ms / 1000 for t in idle_from[-1:]):
                return
    finally:
        query.stop()


# -- first-value state kept as a table ---------------------------------------------------


def first_state_stream(
    df: DataFrame, path: str, checkpoint: str, key: str, order: Sequence[str], kept: Column,
    flag: Callable[[Column], Column], name: str, trigger: Mapping = AVAILABLE_NOW,
) -> StreamingQuery:
    """Flag rows by the first value of their key, without a Python group per key.

    Each micro-batch reduces its rows to one first value per key (combined before
    the shuffle), adds them to the state table, and joins the batch with the
    state; Spark splits a hot key in both steps.  The first batch of a key sets
    its state.  State and output of a batch are overwritten on a replay.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            box = F.min_by(F.struct(kept.alias("state")), F.struct(*order)).alias("_box")
            first = batch.groupBy(F.col(key).alias("_key")).agg(box)
            first.write.mode("overwrite").parquet(f"{path}/state/batch_id={batch_id}")
            reader = batch.sparkSession.read.option("basePath", f"{path}/state")
            seen = reader.parquet(f"{path}/state").filter(F.col("batch_id") <= batch_id)
            state = seen.groupBy("_key").agg(F.min_by("_box", "batch_id").alias("_b")).select(
                "_key", F.col("_b.state").alias("_state")
            )
            joined = batch.join(state, F.col(key).eqNullSafe(F.col("_key")))
            out = joined.select(*batch.columns, flag(F.col("_state")).alias(name))
            out.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def repair_new_flag_table(df: DataFrame, path: str, checkpoint: str, key: str, order: Sequence[str], ts: str, flag: str) -> StreamingQuery:
    """New-visitor repair on the state table."""
    day = F.to_date(ts)
    kept = F.when(F.col(flag) == "1", day).otherwise(F.date_sub(day, 1))

    def fixed(state: Column) -> Column:
        return F.when((F.col(flag) == "1") & (day != state), F.lit("0")).otherwise(F.col(flag))

    return first_state_stream(df, path, checkpoint, key, order, kept, fixed, "fixed_" + flag)


def first_login_table(df: DataFrame, path: str, checkpoint: str, user: str, order: Sequence[str], ts: str) -> StreamingQuery:
    """First-login flag on the state table."""
    day = F.to_date(ts)
    return first_state_stream(
        df, path, checkpoint, user, order, day, lambda s: F.when(day == s, 1).otherwise(0), "is_first"
    )


def first_seen_table(df: DataFrame, path: str, checkpoint: str, visitor: str, order: Sequence[str]) -> StreamingQuery:
    """First-row flag on the state table; ``order`` is unique per row."""
    place = F.struct(*order)
    return first_state_stream(
        df, path, checkpoint, visitor, order, place, lambda s: F.when(place == s, 1).otherwise(0), "is_new_visitor"
    )


def newer_only_table(
    df: DataFrame, path: str, checkpoint: str, key: str, arrival: Sequence[str], ts: str, slice_by: Column,
    trigger: Mapping = AVAILABLE_NOW,
) -> StreamingQuery:
    """Latest-only filter with the greatest time per key in a state table.

    Inside a micro-batch the running maximum is taken slice by slice, so one key
    may hold any share of the rows.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            top = batch.groupBy(F.col(key).alias("_key")).agg(F.max(ts).alias("_top"))
            top.write.mode("overwrite").parquet(f"{path}/state/batch_id={batch_id}")
            reader = batch.sparkSession.read.option("basePath", f"{path}/state")
            before = reader.parquet(f"{path}/state").filter(F.col("batch_id") < batch_id)
            known = before.groupBy("_key").agg(F.max("_top").alias("_known"))
            marked = ordered_columns(batch, [key], arrival, slice_by, max_before={"_seen": ts})
            joined = marked.join(known, F.col(key).eqNullSafe(F.col("_key")), "left")
            limit = F.greatest("_seen", "_known")
            out = joined.filter(limit.isNull() | (F.col(ts) > limit)).select(*batch.columns)
            out.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
