"""Expiring state, folded keyed tables and replayed slices: restarts, repeated batches, late rows."""

import datetime as dt

from pyspark.sql import functions as F

from saltmarsh.streaming import expiry, merge, replay, versions, windows
from tests.conftest import rows

DAY0 = dt.datetime(2024, 1, 1)


def day(n, seconds=0):
    return DAY0 + dt.timedelta(days=n, seconds=seconds)


def visits(spark):
    """``a`` is away for more than a week twice, ``b`` for exactly 7 days, a null key comes back after 8 days."""
    data = [(1, "a", day(0)), (2, "a", day(1)), (3, "b", day(2)), (4, "a", day(9)), (5, "b", day(9)), (6, None, day(3)), (7, None, day(11)),
            (8, "a", day(9, 60)), (9, "b", day(15)), (10, "a", day(20)), (11, "a", day(20, 1)), (12, "c", day(21))]
    return spark.createDataFrame(data, "id int, k string, ts timestamp")


def first_days(spark, frame, folder, bounds, **more):
    kept = F.to_date("ts")
    replay.replay(frame, folder, "ts", bounds, lambda stream, n: expiry.first_value_stream(
        stream, folder, f"{folder}/cp", "k", ["ts", "id"], "ts", kept, lambda first: F.datediff(F.to_date("ts"), first), "age", **more))
    return rows(spark.read.parquet(f"{folder}/out"), "id", "age")


def test_state_is_forgotten_after_its_lifetime_however_the_stream_is_cut(spark, tmp_path):
    expected = sorted([(1, 0), (2, 1), (3, 0), (4, 0), (5, 7), (6, 0), (7, 0), (8, 0), (9, 13), (10, 0), (11, 0), (12, 0)], key=str)
    cuts = {"one": [], "two": [day(5)], "many": [day(n) for n in (2, 9, 16)]}
    for name, bounds in cuts.items():
        got = first_days(spark, visits(spark), str(tmp_path / name), bounds, fold_every=2)
        assert sorted(got, key=str) == expected, name


def test_generations_hold_live_keys_only_and_batches_can_run_again(spark, tmp_path):
    schema = spark.createDataFrame([], "_key string, _last timestamp, _kept int, _batch long").schema
    state = expiry.Generations(spark, str(tmp_path / "s"), schema, "7 DAYS", fold_every=2)
    for n, (key, when) in enumerate([("old", day(0)), ("new", day(10)), ("new", day(11)), ("other", day(12)), ("last", day(13))]):
        for _ in range(2):  # the second time is a replay
            seen = rows(state.before(n), "_key")
            state.write(spark.createDataFrame([(key, when, n)], "_key string, _last timestamp, _kept int"), n)
        assert ("old",) in seen if n == 1 else ("old",) not in seen
    assert rows(state.before(5), "_key", "_kept") == [("last", 4), ("new", 2), ("other", 3)]
    assert rows(spark.read.parquet(str(tmp_path / "s" / "generation-3")), "_key") == [("new",), ("other",)]


def test_newest_only_starts_anew_after_a_day(spark, tmp_path):
    data = [(1, "a", day(0), 5), (2, "a", day(0, 60), 3), (3, "a", day(0, 90), 9), (4, "a", day(2), 1), (5, "a", day(2, 5), 1), (6, "a", day(2, 9), 4), (7, "b", day(2), 0)]
    frame = spark.createDataFrame(data, "id int, k string, ts timestamp, v int")
    for name, bounds in {"one": [], "many": [day(0, 70), day(1), day(2, 7)]}.items():
        folder = str(tmp_path / name)
        replay.replay(frame, folder, "ts", bounds, lambda stream, n: expiry.newer_only_stream(
            stream, folder, f"{folder}/cp", "k", ["ts", "id"], "ts", "v", fold_every=2))
        assert rows(spark.read.parquet(f"{folder}/out"), "id") == [(1,), (3,), (4,), (6,), (7,)]


PARTIAL = "id string, a string, b string, ts long"


def partial(spark, path, n, *data):
    merge.write_batch(merge._with_times(spark.createDataFrame(list(data), PARTIAL), ["id"], "ts"), n, path)


def test_fold_keeps_every_column_and_late_updates_merge_as_before(spark, tmp_path):
    path = str(tmp_path / "t")
    partial(spark, path, 0, ("1", "x", None, 5), ("2", "only", None, 1))
    partial(spark, path, 1, ("1", None, "early", 1))
    made = merge.fold_partial_rows(spark, path, ["id"], "ts")
    assert (made.number, made.upto) == (1, 1) and merge.fold_partial_rows(spark, path, ["id"], "ts") == made
    versions.remove_folded(spark, path)
    assert versions.batch_numbers(spark, path) == []
    partial(spark, path, 2, ("1", "older", "late", 3), ("3", None, None, 4))
    want = [("1", "x", "late", 5), ("2", "only", None, 1), ("3", None, None, 4)]
    assert rows(merge.current_partial_rows(spark, path, ["id"], "ts")) == want
    again = merge.fold_partial_rows(spark, path, ["id"], "ts")
    assert (again.number, again.upto) == (2, 2) and rows(merge.current_partial_rows(spark, path, ["id"], "ts")) == want


def test_a_fold_without_its_manifest_row_is_not_seen_and_is_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    partial(spark, path, 0, ("1", "x", None, 5))
    spark.createDataFrame([("junk",)], "id string").write.parquet(f"{path}-folds/fold-000001")  # a fold that broke off
    assert rows(merge.current_partial_rows(spark, path, ["id"], "ts")) == [("1", "x", None, 5)]
    assert merge.fold_partial_rows(spark, path, ["id"], "ts").number == 1
    assert rows(merge.current_partial_rows(spark, path, ["id"], "ts")) == [("1", "x", None, 5)]
    merge.compact(spark, path, str(tmp_path / "c"), ["id"], "ts", partial=True)
    assert rows(merge.current_partial_rows(spark, str(tmp_path / "c"), ["id"], "ts")) == [("1", "x", None, 5)]


def test_fold_of_whole_rows_keeps_deletions(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, seq int, gone boolean"
    merge.write_batch(spark.createDataFrame([("a", 1, False), ("b", 5, True)], schema), 0, path)
    merge.fold_rows(spark, path, ["k"], "seq")
    merge.write_batch(spark.createDataFrame([("b", 2, False), ("a", 3, None)], schema), 1, path)  # an older row of b
    assert rows(merge.current_rows(spark, path, ["k"], "seq", "gone"), "k", "seq") == [("a", 3)]


def test_late_rows_change_open_windows_and_are_counted_after_they_close(spark, tmp_path):
    """Rows (time, arrival): one 20 seconds late but within an open window, one after its window has closed."""
    data = [("x", day(0, 10), day(0, 10)), ("x", day(0, 70), day(0, 70)), ("x", day(0, 58), day(0, 72)), ("x", day(0, 300), day(0, 300)),
            ("x", day(0, 59), day(0, 301)), ("x", day(0, 295), day(0, 302))]
    frame = spark.createDataFrame(data, "keyword string, ts timestamp, arrival timestamp")
    folder, bounds = str(tmp_path / "late"), [day(0, 71), day(0, 301)]

    def start(stream, n):
        mark = replay.watermark_before(frame, "ts", "arrival", bounds[n - 1], "15 SECONDS") if n else None
        timely = windows.counted_late(windows.with_lateness(stream, "ts"), "ts", "1 minute", mark)
        return merge.upsert_stream(windows.keyword_counts(timely, "ts"), f"{folder}/out", f"{folder}/cp", ["stt", "keyword"], "keyword_count")

    reports = replay.replay(frame, folder, "arrival", bounds, start)
    assert [windows.late_count(p) for p in reports] == [0, 0, 1]
    assert sum(op["numRowsDroppedByWatermark"] for op in reports[2]["stateOperators"]) == 1  # Spark saw the same row
    got = rows(merge.current_rows(spark, f"{folder}/out", ["stt", "keyword"]), "stt", "keyword_count")
    assert got == [("2024-01-01 00:00:00", 2), ("2024-01-01 00:01:00", 1), ("2024-01-01 00:04:00", 1), ("2024-01-01 00:05:00", 1)]
