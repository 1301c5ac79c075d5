import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from saltmarsh.functions.dates import as_date, in_days, latest_date
from saltmarsh.operators import history, horizons, quality, ranking, relations, sequences
from saltmarsh.plans import boards
from saltmarsh.queries import all_entries
from tests.conftest import rows

D = dt.date


def days(spark, *items):
    return spark.createDataFrame([(u, D(2024, 1, d)) for u, d in items], "user_id string, dt date")


def test_streaks_agree_on_edges(spark):
    frame = days(
        spark, ("run3", 24), ("run3", 25), ("run3", 26), ("run2", 24), ("run2", 25), ("gap", 24), ("gap", 25), ("gap", 27),
        ("edge", 28), ("edge", 29), ("edge", 30), ("long", 24), ("long", 25), ("long", 26), ("long", 28), ("long", 29), ("long", 30),
    )
    as_of = as_date("2024-01-30")
    want = [("edge",), ("long",), ("run3",)]
    assert rows(ranking.streak_by_lead(frame, "user_id", "dt")) == want
    assert rows(ranking.streak_by_islands(frame, "user_id", "dt")) == want
    assert rows(ranking.streak_by_bitmap(frame, "user_id", "dt", as_of)) == want
    assert rows(ranking.streak_by_lead(frame, "user_id", "dt", span=3)) == [("edge",), ("gap",), ("long",), ("run3",)]


def test_streak_outside_the_window_is_ignored(spark):
    from saltmarsh.plans.retail_reports import consecutive_order_users

    frame = days(spark, ("a", 22), ("a", 23), ("a", 24), ("b", 23), ("b", 24), ("b", 25), ("b", 25), ("b", 26))
    got = {m: consecutive_order_users(frame, as_date("2024-01-30"), m).first()["order_continuously_user_count"] for m in ("lead", "islands", "bitmap")}
    assert got == {"lead": 1, "islands": 1, "bitmap": 1}


def test_horizon_sums_and_distinct(spark):
    frame = spark.createDataFrame(
        [("x", "u1", D(2024, 1, 30), 1), ("x", "u1", D(2024, 1, 2), 2), ("x", "u2", D(2024, 1, 24), 4), ("x", "u3", D(2023, 12, 31), 8),
         ("x", "u4", D(2024, 1, 31), 16), (None, "u5", D(2024, 1, 30), 32), ("y", None, D(2024, 1, 30), 64)],
        "k string, u string, dt date, v int",
    )
    as_of = as_date("2024-01-30")
    got = rows(horizons.horizon_distinct(frame, ["k"], "u", "dt", as_of, {"v": F.col("v")}, member_name="n"))
    assert ("x", 1, 1, 1) in got and ("x", 7, 2, 5) in got and ("x", 30, 2, 7) in got
    assert (None, 1, 1, 32) in got and ("y", 30, 0, 64) in got


def test_sliced_columns_match_plain_windows_on_a_hot_key(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), i, rng.choice([None, rng.randint(0, 99)])) for i in range(3000)]
    frame = spark.createDataFrame(data, "k string, i int, v int")
    got = sequences.ordered_columns(
        frame, ["k"], ["i"], sequences.number_slice(F.col("i"), 37), row_number="rn", following={"nxt": "v"}, carried={"car": "v"},
        max_before={"mx": "v"}, running_sum={"rs": "v"},
    )
    w = Window.partitionBy("k").orderBy("i")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = frame.select(
        "*", F.row_number().over(w).alias("rn"), F.lead("v").over(w).alias("nxt"), F.last("v", True).over(upto).alias("car"),
        F.max("v").over(before).alias("mx"), F.sum("v").over(upto).alias("rs"),
    )
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("tie", ["i", "name"])
def test_global_rank_equals_single_task_rank(spark, tie):
    rng = random.Random(5)
    data = [(i, f"n{i:05d}", rng.choice([0.0, 0.0, None, -3.5, round(rng.random() * 1e6, 1), 1e-9])) for i in range(2000)]
    frame = spark.createDataFrame(data, "i int, name string, s double")
    got = ranking.global_row_number(frame, "s", tie, "r")
    want = frame.withColumn("r", F.row_number().over(Window.orderBy(F.col("s").desc_nulls_last(), tie)).cast("long"))
    assert rows(got, "i", "r") == rows(want, "i", "r")


def test_top_n_keeps_ties(spark):
    frame = spark.createDataFrame([("g", "a", 5), ("g", "b", 5), ("g", "c", 4), ("g", "d", 4), ("g", "e", 1), ("h", "z", 1)], "g string, x string, n int")
    assert rows(ranking.top_n(frame, ["g"], "n", 3), "g", "x", "rk") == [("g", "a", 1), ("g", "b", 1), ("g", "c", 3), ("g", "d", 3), ("h", "z", 1)]


def test_align_matches_null_and_one_sided_keys(spark):
    a = spark.createDataFrame([(1, 10), (None, 11)], "k int, a int")
    b = spark.createDataFrame([(2, 20), (None, 21)], "k int, b int")
    c = spark.createDataFrame([(3, 30)], "k int, c int")
    got = rows(relations.align({"a": a, "b": b, "c": c}, ["k"]))
    assert got == [(1, 10, None, None), (2, None, 20, None), (3, None, None, 30), (None, 11, 21, None)]


def test_one_row_and_net_balance(spark):
    a = spark.createDataFrame([(5,)], "a int")
    b = spark.createDataFrame([(7,)], "b int")
    assert rows(relations.one_row([a, b])) == [(5, 7)]
    plus = spark.createDataFrame([("x", 5), ("y", 1)], "k string, n int")
    minus = spark.createDataFrame([("x", 2), ("z", 3)], "k string, n int")
    assert rows(relations.net_balance(plus, minus, ["k"], ["n"])) == [("x", 3), ("y", 1), ("z", -3)]


def test_interval_join_boundaries(spark):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    left = spark.createDataFrame([("k", t(100), 1), ("j", t(100), 2), (None, t(100), 3)], "k string, ts timestamp, l int")
    right = spark.createDataFrame([("k", t(s), s) for s in (39, 40, 100, 220, 221)] + [(None, t(100), 7)], "k string, ts timestamp, r int")
    got = relations.interval_join(left, right, ["k"], "ts", "ts", 60, 120, {"l": "l"}, {"r": "r"})
    assert rows(got, "l", "r") == [(1, 100), (1, 220), (1, 40)]


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(9)
    base = dt.datetime(2024, 1, 1)

    def side(n):
        return [("hot" if rng.random() < 0.5 else str(rng.randint(0, 3)), base + dt.timedelta(seconds=rng.randint(0, 5000)), i) for i in range(n)]

    a, b = side(150), side(150)
    left, right = spark.createDataFrame(a, "k string, ts timestamp, l int"), spark.createDataFrame(b, "k string, ts timestamp, r int")
    got = rows(relations.interval_join(left, right, ["k"], "ts", "ts", 30, 90, {"l": "l"}, {"r": "r"}), "l", "r")
    want = [(l, r) for k, t, l in a for q, u, r in b if k == q and -30 <= (u - t).total_seconds() <= 90]
    assert sorted(got) == sorted(want)


def test_decode_miss_and_climb(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "zz")], "id int, code string")
    dic = spark.createDataFrame([("a", "Alpha", "11"), ("zz", "Other", "12")], "dic_code string, dic_name string, parent_code string")
    assert rows(relations.decode(facts, dic, "code", "name", "11", missing="N/A"), "id", "name") == [(1, "Alpha"), (2, "N/A")]
    tree = spark.createDataFrame([(1, "district", 2), (2, "city", 3), (3, "province", None)], "id int, name string, parent_id int")
    got = relations.climb(spark.createDataFrame([(1,), (9,)], "place int"), tree, "place", ["d", "c", "p"])
    assert rows(got, "place", "c_name", "p_id") == [(1, "city", 3), (9, None, None)]


def test_history_build_apply_and_lookup(spark):
    changes = spark.createDataFrame(
        [("u", D(2024, 1, 1), "a", 1), ("u", D(2024, 1, 5), "b", 2), ("u", D(2024, 1, 5), "c", 3), ("v", D(2024, 1, 3), "x", 1)],
        "k string, d date, level string, seq int",
    )
    built = history.build_history(changes, ["k"], "d", ["seq"]).drop("seq")
    open_end = D(9999, 12, 31)
    assert rows(built, "k", "level", "start_date", "end_date") == [
        ("u", "a", D(2024, 1, 1), D(2024, 1, 4)), ("u", "c", D(2024, 1, 5), open_end), ("v", "x", D(2024, 1, 3), open_end)]
    new = spark.createDataFrame([("u", "d"), ("w", "n")], "k string, level string")
    after = history.apply_changes(built, new, ["k"], as_date("2024-01-10"))
    assert rows(after, "k", "level", "end_date") == [
        ("u", "a", D(2024, 1, 4)), ("u", "c", D(2024, 1, 9)), ("u", "d", open_end), ("v", "x", open_end), ("w", "n", open_end)]
    facts = spark.createDataFrame([("u", D(2024, 1, 4)), ("u", D(2024, 1, 5)), ("v", D(2024, 1, 1))], "k string, day date")
    assert rows(history.range_lookup(facts, built, ["k"], "day", ["level"])) == [("u", D(2024, 1, 4), "a"), ("u", D(2024, 1, 5), "c"), ("v", D(2024, 1, 1), None)]


def test_as_of_lookup_takes_equal_time_and_earlier_slices(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    facts = spark.createDataFrame([("u", t(0)), ("u", t(5)), ("u", t(9)), ("v", t(9))], "k string, ts timestamp")
    versions = spark.createDataFrame([("u", t(1), "a", None), ("u", t(5), "b", 2)], "k string, vts timestamp, name string, n int")
    got = history.as_of_lookup(facts, versions, ["k"], "ts", "vts", ["name", "n"])
    assert rows(got, "k", "name", "n") == [("u", "b", 2), ("u", "b", 2), ("u", None, None), ("v", None, None)]


def test_quality_operators(spark):
    base = spark.createDataFrame([("a", 5), ("b", 1), ("c", 3)], "k string, visits int")
    clicks = spark.createDataFrame([("a", 2), ("a", 2), ("b", 2)], "k string, clicks int")
    assert rows(quality.exceeding(base, clicks, ["k"], "visits", "clicks"), "k") == [("b",)]
    left = spark.createDataFrame([("a", 100.0), ("b", 1.0), ("c", 5.0)], "k string, m double")
    right = spark.createDataFrame([("a", 100.05), ("b", 1.1)], "k string, m double")
    assert rows(quality.differing(left, right, ["k"], "m"), "k") == [("b",), ("c",)]
    frame = spark.createDataFrame([(" ", 1, 1.0), ("x", None, 1.0), ("x", 1, 0.0), ("x", 1, 2.0)], "k string, t int, a double")
    assert quality.valid_rows(frame, ["k"], ["t"], ["a"]).count() == 1


def test_empty_inputs_give_empty_or_zero(spark):
    empty = spark.createDataFrame([], "user_id string, dt date")
    assert ranking.streak_by_lead(empty, "user_id", "dt").count() == 0
    assert empty.agg(F.count("*")).filter(latest_date(empty, "dt").isNull()).count() == 1
    scored = spark.createDataFrame([], "i int, s double")
    assert ranking.global_row_number(scored, "s", "i", "r").count() == 0


def test_latest_and_first_per_key(spark):
    frame = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 1, "c")], "k string, t int, v string")
    assert rows(ranking.latest_per_key(frame, ["k"], [F.col("t")])) == [("x", 1, "c"), (None, 2, "b")]
    assert rows(ranking.first_per_key(frame, ["k"], [F.col("t")])) == [("x", 1, "c"), (None, 1, "a")]


def test_global_rank_spreads_equal_scores_over_all_tasks(spark):
    """One score for all rows: high ids and urls with one long head are still cut into even ranges."""
    ids = spark.range(10**12, 10**12 + 2_000_000).select(F.lit(1.0).alias("s"), F.col("id").alias("tie"))
    urls = ids.limit(400_000).select("s", F.concat(F.lit("https://www.example.org/a/very/long/common/head/"), F.col("tie").cast("string")).alias("tie"))
    for frame, n in ((ids, 2_000_000), (urls, 400_000)):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else small ranges are put together
        try:
            spread = ranking.ranged(frame.repartition(16), [F.col("s").desc_nulls_last(), F.col("tie")]).groupBy("_part").count().collect()
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        sizes = [r["count"] for r in spread]
        assert len(sizes) == 8 and max(sizes) < 2 * n / 8
    got = ranking.global_row_number(ids, "s", "tie", "r")
    assert got.where("r <> tie - 1000000000000 + 1").count() == 0 and got.count() == 2_000_000


def test_positions_within_a_hot_key(spark):
    frame = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.when(F.col("id") % 2 == 0, F.col("id").cast("string"))).alias("k"),
        (F.col("id") % 5).alias("w"))
    about = frame.select("k").distinct().withColumn("info", F.length("k"))
    got = ranking.ordered_positions(frame, ["k"], [F.col("id").desc()], "at", "n", {"before": "w"}, about)
    w = Window.partitionBy("k").orderBy(F.col("id").desc())
    rows_before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = frame.select(
        "*", (F.row_number().over(w) - 1).cast("long").alias("at"), F.count("*").over(Window.partitionBy("k")).alias("n"),
        F.coalesce(F.sum("w").over(rows_before), F.lit(0)).alias("before"), F.length("k").alias("info"))
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and got.count() == 30_000
    assert ranking.ordered_positions(frame.limit(0), ["k"], [F.col("id")], "at").count() == 0


def test_decoding_does_not_move_the_fact(spark):
    fact = spark.range(1000).select("id", (F.col("id") % 4).cast("string").alias("code"))
    codes = spark.createDataFrame([("0", "zero", "p"), ("1", "one", "p"), ("1", "uno", "p"), (None, "none", "p"), ("2", "two", "q")], "dic_code string, dic_name string, parent_code string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = relations.decode(fact, codes, "code", "name", "p", missing="?")
        plan = got._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        assert "Exchange" not in plan and "Join" not in plan
        assert rows(got.groupBy("code", "name").count()) == [("0", "zero", 250), ("1", "one", 250), ("2", "?", 250), ("3", "?", 250)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert relations.decode(fact, codes.limit(0), "code", "name").filter("name IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="has to be joined"):
        fact.select(F.size(relations.code_names(fact, "id", "code", largest=999))).collect()


def test_repeated_keys_are_refused_when_summaries_are_aligned(spark):
    a = spark.createDataFrame([("p", 10, "c2"), ("p", 7, "c1")], "k string, sales int, cat string")
    b = spark.createDataFrame([("p", 1), (None, 2)], "k string, n int")
    with pytest.raises(Exception, match="several rows with the same k"):
        relations.align({"sale": a, "visit": b}, ["k"]).collect()
    with pytest.raises(ValueError):
        relations.align({"one": b, "two": b}, ["k"])
    assert rows(relations.align({"visit": b}, ["k"])) == [("p", 1), (None, 2)]


def test_hot_products_add_up_sales_in_several_categories(spark):
    sales = spark.createDataFrame([(1, "x", "c2", 7.0), (1, "x", "c1", 10.0), (2, "y", "c1", 1.0)], "product_id int, product_name string, category_id string, total_sales_amount double")
    visits = spark.createDataFrame([(1, 10, 0.5), (1, 30, 0.1), (3, 5, 0.0)], "product_id int, total_visit_num int, pay_conversion_rate double")
    got = boards.hot_products(sales, visits)
    assert rows(got, "product_id", "category_id", "total_sales_amount", "total_visit_num", "hot_rank") == [
        (1, "c1", 17.0, 40, 1), (2, "c1", 1.0, 0, 3), (3, None, 0.0, 5, 2)]
    assert [round(r[0], 6) for r in got.filter("product_id = 1").select("conversion_rate").collect()] == [0.2]


def test_a_day_can_be_applied_again_and_late(spark):
    day1, day2 = as_date("2025-02-01"), as_date("2025-03-01")
    first = history.open_history(spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, v int"), as_date("2025-01-01"))
    new = spark.createDataFrame([("a", 2), ("c", 2), (None, 2)], "k string, v int")
    once = history.apply_changes(first, new, ["k"], day1)
    assert rows(history.apply_changes(once, new, ["k"], day1)) == rows(once) and once.count() == 6
    later = history.apply_changes(once, spark.createDataFrame([("a", 3)], "k string, v int"), ["k"], day2)
    again = history.apply_changes(later, new, ["k"], day1)  # an older day runs once more
    assert rows(again) == rows(later)
    assert rows(later.filter("k = 'a'"), "v", "start_date", "end_date") == [
        (1, D(2025, 1, 1), D(2025, 1, 31)), (2, D(2025, 2, 1), D(2025, 2, 28)), (3, D(2025, 3, 1), D(9999, 12, 31))]


def test_day_ranges_on_raw_columns(spark):
    stamps = ["2025-01-31 23:59:59.999", "2025-02-01 00:00:00", "2025-02-02 23:59:59.999", "2025-02-03 00:00:00", None]
    frame = spark.createDataFrame([(k, s) for k, s in enumerate(stamps)], "id int, text string").select(
        "id", "text", F.col("text").cast("timestamp").alias("ts"), F.to_date("text").alias("d"), F.unix_millis(F.col("text").cast("timestamp")).alias("ms"))
    for column in ("text", "ts", "d", "ms"):
        assert rows(frame.filter(in_days(frame, column, as_date("2025-02-01"), as_date("2025-02-02"))), "id") == [(1,), (2,)]
    with pytest.raises(TypeError):
        in_days(frame, "id", as_date("2025-02-01"), as_date("2025-02-02"))


@pytest.mark.parametrize("name, column", [
    ("l07_org_cargo_orders_nd", "l_shipdate"), ("l09_shift_transport_nd", "l_shipdate"), ("l12_transport_totals", "l_shipdate"),
    ("l14_city_report", "l_shipdate"), ("l15_line_report", "l_shipdate"), ("l16_driver_report", "l_shipdate"), ("l11_receive_dispatch_report", "o_orderdate")])
def test_report_days_reach_the_scan(spark, name, column):
    made = all_entries()[name].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution()
    plan = made.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scans = [line for line in plan.split("PushedFilters: ")[1:] if column in line.split("]")[0]]
    assert scans and any(f"GreaterThanOrEqual({column},2001-07-0" in s and f"LessThan({column},2001-08-01" in s for s in scans)


def kept_partitions(df) -> bool:
    return "REPARTITION_BY_NUM" in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["l07_org_cargo_orders_1d", "l08_org_receive_1d", "l08_dispatch_1d", "l08_bound_finish_td", "l10_org_deliver_1d"])
def test_parcel_summaries_keep_their_partitions(spark, name):
    """Before, adaptive execution merged the partitions in which lines are joined and grouped by order."""
    assert kept_partitions(all_entries()[name].run(spark, "/root/testdata/sf0.001"))


@pytest.mark.parametrize("name", ["s01_province_order_1d", "s06_user_order_1d", "s07_user_order_td", "s08_user_payment_1d", "s09_user_sku_order_1d"])
def test_order_summaries_keep_their_partitions(spark, name):
    """Before, adaptive execution merged the partitions in which lines are joined and grouped by order."""
    assert kept_partitions(all_entries()[name].run(spark, "/root/testdata/sf0.001"))


@pytest.mark.parametrize("name", ["w06_product_sale_summary", "w06_line_product_sales"])
def test_sale_summaries_keep_their_partitions(spark, name):
    """Before, orders were counted in the merged partitions that also sort the sales."""
    assert kept_partitions(all_entries()[name].run(spark, "/root/testdata/sf0.001"))
