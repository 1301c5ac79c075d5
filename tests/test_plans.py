import datetime as dt
import json

from pyspark.sql import functions as F

from saltmarsh.functions.dates import as_date
from saltmarsh.plans import boards, logistics, moderation, profile, retail_facts, retail_reports, retail_summaries, shop_traffic, vehicles
from tests.conftest import rows

D = dt.date
T = lambda d, h=0, m=0: dt.datetime(2024, 1, d, h, m)


def log_line(**parts):
    return (json.dumps(parts),)


def test_page_and_login_facts_from_logs(spark):
    ms = 1704067200000  # 2024-01-01 00:00 UTC = 08:00 in the log zone
    logs = spark.createDataFrame([
        log_line(common={"mid": "m1", "uid": "7", "sid": "s1", "ch": "app"}, page={"page_id": "home", "during_time": 5}, ts=ms + 1000),
        log_line(common={"mid": "m1", "uid": "7", "sid": "s1", "ch": "web"}, page={"page_id": "cart", "during_time": 6}, ts=ms),
        log_line(common={"mid": "m2", "sid": "s2"}, page={"page_id": "home"}, ts=ms + 60_000 * 60 * 20),
        log_line(common={"mid": "m3"}, start={"entry": "icon"}, ts=ms), ("{broken",),
    ], "log string")
    views = retail_facts.page_view_fact(logs)
    assert rows(views, "mid_id", "page_id", "dt") == [("m1", "cart", D(2024, 1, 1)), ("m1", "home", D(2024, 1, 1)), ("m2", "home", D(2024, 1, 2))]
    assert rows(retail_facts.page_view_fact_by_path(logs.filter("log not like '{broken%'")), *views.columns) == rows(views)
    assert rows(retail_facts.login_fact(views), "user_id", "channel", "login_time") == [("7", "web", "2024-01-01 08:00:00")]


def test_layered_equals_direct_orders(spark):
    """Orders of 30 days by province through the layers and straight from the detail."""
    detail = spark.createDataFrame(
        [(i, i // 2, i % 5, i % 3, D(2024, 1, 1 + i % 30)) for i in range(300)], "id int, order_id int, user_id int, province_id int, dt date"
    )
    for c in ("split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"):
        detail = detail.withColumn(c, F.col("id").cast("decimal(16,2)"))
    as_of = as_date("2024-01-30")
    layered = retail_reports.orders_by_province(retail_summaries.province_order_1d(detail), as_of).filter("recent_days = 30")
    direct = detail.groupBy("province_id").agg(F.sum("split_total_amount").alias("order_total_amount"))
    assert rows(layered, "province_id", "order_total_amount") == rows(direct)


def test_page_path_edges(spark):
    views = spark.createDataFrame(
        [("s", "home", T(1, 0, 1)), ("s", "list", T(1, 0, 2)), ("s", "home", T(1, 5)), ("t", "home", T(1, 9))], "session_id string, page_id string, ts timestamp"
    )
    got = rows(retail_reports.page_path(views, ["ts"], "ts"))
    assert got == [("step-1:home", "null", 1), ("step-1:home", "step-2:list", 1), ("step-2:list", "step-3:home", 1), ("step-3:home", "null", 1)]


def test_churn_and_return(spark):
    logins = spark.createDataFrame(
        [("gone", D(2024, 1, 23)), ("back", D(2024, 1, 30)), ("back", D(2024, 1, 22)), ("near", D(2024, 1, 30)), ("near", D(2024, 1, 23)), ("new", D(2024, 1, 30))],
        "user_id string, dt date",
    )
    assert rows(retail_reports.user_change(logins, as_date("2024-01-30")), "user_churn_count", "user_back_count") == [(1, 1)]


def test_retention_and_repeat_ratios(spark):
    td = spark.createDataFrame(
        [("a", D(2024, 1, 30), D(2024, 1, 29)), ("b", D(2024, 1, 29), D(2024, 1, 29)), ("c", D(2024, 1, 30), D(2024, 1, 29)), ("d", D(2024, 1, 30), D(2024, 1, 22))],
        "user_id string, login_date_last date, login_date_first date",
    )
    got = retail_reports.user_retention(td, as_date("2024-01-30")).collect()
    assert [(r["create_date"], r["retention_day"], float(r["retention_rate"])) for r in got] == [(D(2024, 1, 29), 1, 66.67)]


def test_trade_flow_keeps_open_orders(spark):
    order = spark.createDataFrame([(1, 7, 3, T(1)), (2, 8, 3, T(1))], "id int, user_id int, province_id int, create_time timestamp")
    for c in ("original_total_amount", "activity_reduce_amount", "coupon_reduce_amount", "total_amount"):
        order = order.withColumn(c, F.lit(10))
    pay = spark.createDataFrame([(1, T(2), 10)], "order_id int, callback_time timestamp, total_amount int")
    done = spark.createDataFrame([(1, "1004", T(5)), (2, "1001", T(5))], "order_id int, order_status string, operate_time timestamp")
    flow = retail_facts.trade_flow(order, pay, done)
    assert rows(flow, "order_id", "payment_date_id", "dt") == [(1, D(2024, 1, 2), D(2024, 1, 5)), (2, D(9999, 12, 31), D(9999, 12, 31))]
    assert retail_reports.order_to_pay_seconds(flow, as_date("2024-01-30")).first()["order_to_pay_interval_avg"] == 86400


def test_drivers_share_distance_but_not_trips(spark):
    nd = spark.createDataFrame(
        [(7, 1, "a*", None, None, 2, 10.0, 100), (7, 1, "a*", 2, "b*", 3, 8.0, 60)],
        "recent_days int, driver1_emp_id int, driver1_name string, driver2_emp_id int, driver2_name string, trans_finish_count int, trans_finish_distance double, trans_finish_dur_sec int",
    )
    got = rows(logistics.driver_report(nd, as_date("2024-01-30")), "driver_emp_id", "trans_finish_count", "trans_finish_distance", "avg_trans_finish_dur_sec")
    assert got == [(1, 5, 14.0, 26.0), (2, 3, 4.0, 10.0)]


def test_in_transit_and_place_report_one_sided(spark):
    a, b = spark.createDataFrame([(5, 50)], "order_count int, order_amount int"), spark.createDataFrame([(2, 20)], "order_count int, order_amount int")
    assert rows(logistics.in_transit_report(a, b)) == [(3, 30)]
    orders = spark.createDataFrame([(1, "x", D(2024, 1, 30), 5, 50)], "city_id int, city_name string, dt date, order_count int, order_amount int")
    trips = spark.createDataFrame([(2, "y", D(2024, 1, 1), 4, 8, 40)], "city_id int, city_name string, dt date, trans_finish_count int, trans_finish_distance int, trans_finish_dur_sec int")
    got = rows(logistics.place_report(orders, trips, ["city_id", "city_name"], as_date("2024-01-30")), "recent_days", "city_id", "order_count", "trans_finish_count", "avg_trans_finish_distance")
    assert got == [(1, 1, 5, None, None), (30, 1, 5, None, None), (30, 2, None, 4, 2.0), (7, 1, 5, None, None)]


def test_efficiency_counts_distinct_users_per_source(spark):
    v = spark.createDataFrame([(1, 7), (1, 7), (1, 8)], "product_id int, user_id int")
    c = spark.createDataFrame([(2, 7)], "product_id int, user_id int")
    k = spark.createDataFrame([(1, 7, 3)], "product_id int, user_id int, cart_quantity long")
    o = spark.createDataFrame([(1, 7, 2, 0, None), (1, 7, 1, 1, 7)], "product_id int, user_id int, quantity long, paid_quantity long, paid_user_id int")
    o = o.withColumn("amount", F.col("quantity").cast("decimal(16,2)")).withColumn("paid_amount", F.col("paid_quantity").cast("decimal(16,2)"))
    got = rows(boards.product_efficiency(v, c, k, o), "product_id", "view_count", "visitor_count", "collect_count", "cart_user_count", "order_quantity", "paid_user_count")
    assert got == [(1, 3, 2, 0, 1, 3, 1), (2, 0, 0, 1, 0, 0, 0)]


def test_scores_floor_and_grade(spark):
    keys = spark.createDataFrame([(1, 1), (1, 2)], "store_id int, item_id int")

    def part(*names, value):
        return keys.select("*", *[F.when(F.col("item_id") == 1, F.lit(value)).otherwise(F.lit(0.0)).alias(n) for n in names])

    parts = {n: [m for m, _, _ in p] for n, (_, p) in boards.SCORE_PARTS.items()}
    frames = [part(*parts[n], value=100.0) for n in ("traffic_score", "conversion_score", "content_score", "acquisition_score", "service_score")]
    got = boards.product_scores(*frames).orderBy("item_id").collect()
    # content duration 100 counts as 100/3*2 = 66.67 of its 0.4 share
    assert got[0]["content_score"] == 86.67 and got[0]["grade"] == "A"
    assert (got[1]["total_score"], got[1]["grade"]) == (20.0, "D")


def test_moderation_grades(spark):
    frame = spark.createDataFrame([(1, "fine, words,bad"), (2, "inside bad and worse"), (3, "clean"), (4, ""), (5, None), (6, "x,bad,")], "id int, comment_txt string")
    got = rows(moderation.moderate(frame, ["worse", "bad"]), "id", "is_violation", "violation_grade", "violation_msg")
    assert got == [(1, 1, "P0", "bad"), (2, 1, "P1", "worse, bad"), (3, 0, "", ""), (4, 0, "", ""), (5, 0, "", ""), (6, 1, "P0", "bad")]


def test_profile_scores_known_user(spark):
    table = profile.weight_table(spark)
    frame = spark.createDataFrame([("iOS", "性价比", "夜间", "高消费", "苹果", "手机"), (None, "", None, None, "nobody", None)], "judge_os string, cat string, slot string, pow string, tname string, b1 string")
    scored = profile.total_scores(profile.score_factors(frame, table, {"device": "judge_os", "search": "cat", "time": "slot", "amount": "pow", "brand": "tname", "category": "b1"}))
    first, second = scored.collect()
    assert float(first["sum_18_24"]) == round(0.07 + 0.03 + 0.09 + 0.015 + 0.18 + 0.27, 3) and first["best_band"] == "18-24"
    assert float(second["sum_50"]) == 0.12 and second["best_band"] == "50"


def test_weight_table_rounds_half_up():
    got = {(f, v): p for f, v, p in profile.weight_rows()}
    assert str(got[("search", "学习与发展")][3]) == "0.105" and str(got[("amount", "低消费")][4]) == "0.030"


def test_crowd_share_and_ranking_sum_before_rank(spark):
    crowd = spark.createDataFrame([(i, f"v{i}", "m" if i < 3 else "f", "a", "c", 1, 1704067200000 + i) for i in range(4)],
                                  "log_id int, visitor_id string, gender string, age_range string, city string, taoqi_value int, update_time long")
    report = shop_traffic.crowd_report(shop_traffic.crowd_summary(shop_traffic.crowd_detail(crowd)))
    assert rows(report.filter("crowd_type = 'conversion'"), "gender", "crowd_ratio") == [("f", 0.25), ("m", 0.75)]
    summary = spark.createDataFrame([("w", 1, 5), ("w", 1, 6), ("w", 2, 10), ("w", 3, 10)], "stat_time string, product_id int, visitor_count int")
    got = rows(shop_traffic.ranked(summary, ["stat_time"], ["product_id"], "visitor_count", 2), "product_id", "visitor_count", "rank_num")
    assert got == [(1, 11, 1), (2, 10, 2)]


def test_track_distance_of_short_tracks(spark):
    points = spark.createDataFrame([("a", T(1, 0), 0.0, 0.0, 1), ("a", T(1, 5), 0.0, 1.0, 2), ("b", T(1), 3.0, 3.0, 3)], "v string, ts timestamp, lat double, lon double, i int")
    assert rows(vehicles.track_distance(points, "v", "ts", "lat", "lon", "i"), "v", "points", "metres") == [("a", 2, 111319.5), ("b", 1, 0.0)]


def test_user_activity_and_value(spark):
    pages = spark.createDataFrame([("u", D(2024, 1, 30), "item_detail", 4), ("u", D(2024, 1, 30), "home", 9), ("u", D(2024, 1, 2), "home", 1), ("u", D(2023, 12, 1), "home", 1)],
                                  "user_id string, dt date, page_type string, page_count int")
    got = rows(boards.user_activity(pages, as_date("2024-01-30")))
    assert got == [("u", 2, 0.2857, 1.3333)]


def test_category_ids_do_not_collide(spark):
    from saltmarsh.plans import boards

    products = spark.range(20_000).select(F.col("id").alias("product_id"), F.concat(F.lit("category "), F.col("id")).alias("category_name"))
    assert boards.category_dimension(products).select("category_id").distinct().count() == 20_000


def test_sku_names_cover_the_whole_part_table(spark, tmp_path):
    from saltmarsh.queries import traffic

    spark.range(1000).select(
        F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), F.lit(1).alias("p_size"),
        F.lit(1.0).alias("p_retailprice"),
    ).write.parquet(str(tmp_path / "part.parquet"))
    assert traffic._sku_names(spark, str(tmp_path)).count() == 1000


def test_visitor_of_two_sources_counts_once(spark):
    visits = spark.createDataFrame(
        [(1, 7, "c", "a"), (1, 7, "c", "b"), (1, 7, "c", "b"), (2, 7, "c", "b"), (3, 7, "c", None), (None, 7, "c", "a"), (1, 8, "c", "a")],
        "user_id int, product_id int, category_id string, source_name string",
    )
    sales = spark.createDataFrame([(7, 1), (7, 1), (7, None), (9, 4)], "product_id int, user_id int")
    got = {r["product_id"]: r for r in boards.product_visit_summary(visits, sales).collect()}
    assert got[7]["source_visitor_map"] == {"a": 2, "b": 2, "unknown": 1}
    assert [got[7][c] for c in ("total_visitor_num", "total_visit_num", "pay_user_num", "pay_conversion_rate")] == [4, 6, 1, 25.0]
    assert [got[8][c] for c in ("total_visitor_num", "total_visit_num", "pay_user_num", "pay_conversion_rate")] == [1, 1, 0, 0.0]


def test_mean_price_rounds_ties_up(spark):
    # 1080543.63 / 24 and 744885.82 / 16 end in a five at the fifth place
    lines = [(1, 0, "1080543.63")] + [(1, i, "0.00") for i in range(1, 24)] + [(2, 0, "744885.82")] + [(2, i, "0.00") for i in range(1, 16)]
    sales = spark.createDataFrame(lines, "product_id int, order_id int, amount string").select(
        "product_id", "order_id", F.lit("c").alias("category_id"), F.lit("c").alias("category_name"), F.col("amount").cast("decimal(16,2)").alias("pay_amount"), F.lit(1).alias("pay_num")
    )
    names = spark.createDataFrame([(1, "a"), (2, "b")], "product_id int, product_name string")
    assert rows(boards.product_sale_summary(sales, names), "product_id", "avg_price") == [(1, 45022.6513), (2, 46555.3638)]
