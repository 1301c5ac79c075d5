"""Parcel queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from saltmarsh.operators.relations import align
from saltmarsh.plans import logistics as lg
from saltmarsh.queries import adapters as a
from saltmarsh.queries.fragments import ORGANS, PARCELS, PLACES, SHOP_DAY, TASKS, with_
from saltmarsh.queries.registry import query


def _day():
    return a.day(a.SHOP_DAY)


def _recent():
    """The days of the longest horizon; as ranges on raw columns they reach the scans."""
    return F.date_sub(_day(), 29), _day()


def _step(step, codes=lg.CODES, spread=False):
    """Builder of a step fact; summaries decode only the codes they group by and have the lines dealt by order."""

    def run(spark, sf, days=None):
        return lg.order_step_fact(a.cargo(spark, sf), a.parcel_orders(spark, sf), a.parcel_dictionary(spark, sf), step, codes, days, spread)

    return run


def _step_sql(cond: str, day: str) -> str:
    return f"""
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_returnflag AS cargo_type,
       CAST(l_quantity AS DECIMAL(16,2)) AS weight, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS order_time, order_no, status,
       collect_type, user_id, sender_city_id, sender_district_id, receiver_district_id, amount, update_time,
       'C*' AS receiver_name, 'C*' AS sender_name, 'cargo ' || l_returnflag AS cargo_type_name, '' AS status_name,
       collect_type_name, CAST({day} AS DATE) AS dt
FROM lineitem JOIN (
  SELECT o_orderkey, 'N' || CAST(o_orderkey AS VARCHAR) AS order_no, substr(o_orderpriority, 1, 1) AS collect_type,
    o_orderpriority AS collect_type_name, o_custkey AS user_id, c_nationkey AS sender_city_id, c_nationkey AS sender_district_id,
    CAST(o_orderkey % 25 AS INTEGER) AS receiver_district_id, CAST(o_totalprice AS DECIMAL(16,2)) AS amount, o_orderdate AS update_time,
    CASE o_orderstatus WHEN 'F' THEN '60070' WHEN 'P' THEN '60050'
      ELSE CASE WHEN o_orderkey % 2 = 0 THEN '60030' ELSE '60020' END END AS status
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey) o ON l_orderkey = o_orderkey
WHERE {cond}
"""


NOT_IN = {
    "pay": "status NOT IN ('60010', '60999')",
    "cancel": "status = '60020'",
    "receive": "status NOT IN ('60010', '60020', '60999')",
    "dispatch": "status NOT IN ('60010', '60020', '60030', '60040', '60999')",
    "bound_finish": "status NOT IN ('60020', '60030', '60040', '60050')",
    "deliver": "status NOT IN ('60020', '60030', '60040')",
    "sign": "status NOT IN ('60020', '60030', '60040', '60050')",
}
query("l01_order_fact", _step_sql("true", "l_shipdate"))(_step("order"))
for _name, _cond in NOT_IN.items():
    query(f"l01_{_name}_fact", _step_sql(_cond, "update_time"))(_step(_name))


@query("l02_order_process_fact", f"""
SELECT * EXCLUDE (dt), CAST(order_time AS DATE) AS start_date,
       CASE WHEN status IN ('60020', '60030') THEN CAST(update_time AS DATE) ELSE DATE '9999-12-31' END AS end_date,
       CASE WHEN status IN ('60020', '60030') THEN CAST(update_time AS DATE) ELSE DATE '9999-12-31' END AS dt
FROM ({_step_sql("true", "l_shipdate")})
""")
def l02(spark, sf):
    return lg.order_process_fact(a.cargo(spark, sf), a.parcel_orders(spark, sf), a.parcel_dictionary(spark, sf))


@query("l03_transport_finish_fact", with_(TASKS) + """
SELECT id, shift_id, line_id, org_id AS start_org_id, org_name AS start_org_name, driver1_emp_id, driver1_name, driver2_emp_id,
       driver2_name, truck_id, md5('P' || CAST(truck_id AS VARCHAR)) AS truck_no, strftime(ship, '%Y-%m-%d %H:%M:%S') AS actual_start_time,
       strftime(ship + CAST(dur // 60 AS BIGINT) * INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS actual_end_time, dist AS actual_distance, order_num, '0' AS is_deleted,
       dur AS finish_dur_sec, dt
FROM tasks
""")
def l03(spark, sf):
    return a.transports(spark, sf)


def _scans(spark, sf, days=None):
    l, s = a.shipped_around(spark, sf, days), a.table(spark, sf, "supplier")
    start = F.unix_millis("l_shipdate")
    return l.join(s, l.l_suppkey == s.s_suppkey, "left").select(
        a.line_id().alias("id"), F.col("l_orderkey").alias("order_id"), (F.col("s_nationkey") + 1000).alias("org_id"),
        F.when(F.col("l_linenumber") > 1, start).alias("inbound_time"),
        F.when(F.col("l_linenumber") > 2, start + 3600000).alias("sort_time"),
        F.when(F.col("l_linenumber") > 3, start + 7200000).alias("outbound_time"),
        F.col("l_suppkey").alias("inbound_emp_id"), F.col("l_suppkey").alias("sorter_emp_id"),
        F.col("l_suppkey").alias("outbound_emp_id"),
    )


def _bound_sql(n: int, hours: int, moment: str, emp: str) -> str:
    return f"""
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, s_nationkey + 1000 AS org_id,
       strftime(l_shipdate + INTERVAL {hours} HOUR, '%Y-%m-%d %H:%M:%S') AS {moment}, l_suppkey AS {emp},
       CAST(l_shipdate + INTERVAL {hours} HOUR AS DATE) AS dt
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber > {n}
"""


@query("l04_inbound_fact", _bound_sql(1, 0, "inbound_time", "inbound_emp_id"))
def l04_in(spark, sf):
    return lg.bound_fact(_scans(spark, sf), "inbound_time", "inbound_emp_id")


@query("l04_sort_fact", _bound_sql(2, 1, "sort_time", "sorter_emp_id"))
def l04_sort(spark, sf):
    return lg.bound_fact(_scans(spark, sf), "sort_time", "sorter_emp_id")


@query("l04_outbound_fact", _bound_sql(3, 2, "outbound_time", "outbound_emp_id"))
def l04_out(spark, sf):
    return lg.bound_fact(_scans(spark, sf), "outbound_time", "outbound_emp_id")


# -- dimensions -----------------------------------------------------------------------


@query("l05_complex_dimension", """
SELECT n.n_nationkey AS id, n.n_name AS complex_name, n.n_nationkey AS province_id, n.n_name AS province_name,
       n.n_regionkey + 100 AS city_id, r_name AS city_name,
       coalesce(c.ids, '') AS courier_emp_ids
FROM nation n JOIN region ON n.n_regionkey = r_regionkey
LEFT JOIN (SELECT s_nationkey, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY CAST(s_suppkey AS VARCHAR)) AS ids FROM supplier GROUP BY 1) c
  ON n.n_nationkey = s_nationkey
""")
def l05_complex(spark, sf):
    c = a.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("complex_name"), F.col("n_nationkey").alias("province_id"),
        (F.col("n_regionkey") + 100).alias("city_id"),
    )
    couriers = a.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("complex_id"), F.col("s_suppkey").alias("courier_emp_id"))
    out = lg.complex_dimension(c, a.places(spark, sf), couriers)
    return out.withColumn("courier_emp_ids", F.array_join("courier_emp_ids", ","))


@query("l05_organ_dimension", """
SELECT n_nationkey + 1000 AS id, 'ORG_' || n_name AS org_name, CASE WHEN n_regionkey % 2 = 0 THEN 1 ELSE 2 END AS org_level,
       n_nationkey AS region_id, n_regionkey + 1000 AS org_parent_id, n_name AS region_name, 'N' || CAST(n_nationkey AS VARCHAR) AS region_code,
       'ORG_NATION_' || CAST(n_regionkey AS VARCHAR) AS org_parent_name
FROM nation
""")
def l05_organ(spark, sf):
    return lg.organ_dimension(a.organs(spark, sf), a.places(spark, sf))


@query("l05_region_dimension", """
SELECT n_nationkey AS id, n_regionkey + 100 AS parent_id, n_name AS name, 'N' || CAST(n_nationkey AS VARCHAR) AS dict_code, n_name AS short_name FROM nation
UNION ALL SELECT r_regionkey + 100, r_regionkey % 2 + 200, r_name, 'R' || CAST(r_regionkey AS VARCHAR), r_name FROM region
UNION ALL SELECT DISTINCT r_regionkey % 2 + 200, CAST(NULL AS INTEGER), 'TOP_' || CAST(r_regionkey % 2 AS VARCHAR), 'T' || CAST(r_regionkey % 2 AS VARCHAR), CAST(NULL AS VARCHAR) FROM region
""")
def l05_region(spark, sf):
    return lg.region_dimension(a.places(spark, sf))


@query("l05_courier_dimension", """
SELECT s_suppkey AS id, s_suppkey AS emp_id, s_nationkey + 1000 AS org_id, 'ORG_' || n_name AS org_name, md5('1' || CAST(s_suppkey AS VARCHAR)) AS working_phone,
       p AS express_type, n AS express_type_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS p, o_orderpriority AS n FROM orders) ON p = CAST(s_suppkey % 5 + 1 AS VARCHAR)
""")
def l05_courier(spark, sf):
    c = a.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("emp_id"), (F.col("s_nationkey") + 1000).alias("org_id"),
        F.concat(F.lit("1"), F.col("s_suppkey")).alias("working_phone"), (F.col("s_suppkey") % 5 + 1).cast("string").alias("express_type"),
    )
    return lg.courier_dimension(c, a.organs(spark, sf), a.parcel_dictionary(spark, sf))


@query("l05_shift_dimension", """
SELECT p_partkey AS id, p_partkey % 10 AS line_id, p_name AS start_time, 'line ' || CAST(p_partkey % 10 AS VARCHAR) AS line_name,
       CAST(p_partkey % 10 % 5 + 1 AS VARCHAR) AS transport_line_type_id, n AS transport_line_type_name
FROM part JOIN (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS p, o_orderpriority AS n FROM orders) ON p = CAST(p_partkey % 10 % 5 + 1 AS VARCHAR)
""")
def l05_shift(spark, sf):
    p = a.table(spark, sf, "part")
    line = F.col("p_partkey") % 10
    shifts = p.select(F.col("p_partkey").alias("id"), line.alias("line_id"), F.col("p_name").alias("start_time"))
    lines = p.select(line.alias("id")).distinct().select(
        "id", F.concat(F.lit("line "), "id").alias("name"), (F.col("id") % 5 + 1).cast("string").alias("transport_line_type_id")
    )
    return lg.shift_dimension(shifts, lines, a.parcel_dictionary(spark, sf))


@query("l05_driver_dimension", """
SELECT s_suppkey AS id, s_nationkey + 1000 AS org_id, s_suppkey % 7 AS team_id, md5('L' || CAST(s_suppkey AS VARCHAR)) AS license_no,
       'ORG_' || n_name AS org_name, 'team ' || CAST(s_suppkey % 7 AS VARCHAR) AS team_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def l05_driver(spark, sf):
    s = a.table(spark, sf, "supplier")
    team = F.col("s_suppkey") % 7
    drivers = s.select(
        F.col("s_suppkey").alias("id"), (F.col("s_nationkey") + 1000).alias("org_id"), team.alias("team_id"),
        F.concat(F.lit("L"), F.col("s_suppkey")).alias("license_no"),
    )
    teams = s.select(team.alias("id"), F.concat(F.lit("team "), team).alias("name")).distinct()
    return lg.driver_dimension(drivers, teams, a.organs(spark, sf))


@query("l05_truck_dimension", """
WITH d AS (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS p, o_orderpriority AS n FROM orders)
SELECT s_suppkey AS id, s_suppkey % 7 AS team_id, s_suppkey % 4 AS truck_model_id, md5('P' || CAST(s_suppkey AS VARCHAR)) AS truck_no,
  'team ' || CAST(s_suppkey % 7 AS VARCHAR) AS team_name, 'T' || CAST(s_suppkey % 7 AS VARCHAR) AS team_no,
  CAST(s_suppkey % 7 AS INTEGER) + 1000 AS org_id, s_suppkey % 7 AS manager_emp_id,
  'model ' || CAST(s_suppkey % 4 AS VARCHAR) AS truck_model_name, CAST(s_suppkey % 4 % 5 + 1 AS VARCHAR) AS truck_model_type,
  'M' || CAST(s_suppkey % 4 AS VARCHAR) AS truck_model_no, CAST(s_suppkey % 4 % 3 + 1 AS VARCHAR) AS truck_brand,
  'ORG_NATION_' || CAST(s_suppkey % 7 AS VARCHAR) AS org_name, t.n AS truck_model_type_name, b.n AS truck_brand_name
FROM supplier JOIN d t ON t.p = CAST(s_suppkey % 4 % 5 + 1 AS VARCHAR) JOIN d b ON b.p = CAST(s_suppkey % 4 % 3 + 1 AS VARCHAR)
""")
def l05_truck(spark, sf):
    s = a.table(spark, sf, "supplier")
    team, model = F.col("s_suppkey") % 7, F.col("s_suppkey") % 4
    trucks = s.select(
        F.col("s_suppkey").alias("id"), team.alias("team_id"), model.alias("truck_model_id"),
        F.concat(F.lit("P"), F.col("s_suppkey")).alias("truck_no"),
    )
    teams = s.select(team.alias("id")).distinct().select(
        "id", F.concat(F.lit("team "), "id").alias("name"), F.concat(F.lit("T"), "id").alias("team_no"),
        (F.col("id").cast("int") + 1000).alias("org_id"), F.col("id").alias("manager_emp_id"),
    )
    models = s.select(model.alias("id")).distinct().select(
        "id", F.concat(F.lit("model "), "id").alias("model_name"), (F.col("id") % 5 + 1).cast("string").alias("model_type"),
        F.concat(F.lit("M"), "id").alias("model_no"), (F.col("id") % 3 + 1).cast("string").alias("brand"),
    )
    return lg.truck_dimension(trucks, teams, models, a.organs(spark, sf), a.parcel_dictionary(spark, sf))


PHONE_SQL = r"'^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$'"
EMAIL_SQL = r"'^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$'"


@query("l06_user_history", f"""
SELECT c_custkey AS id, md5(c_mktsegment) AS passwd, md5(c_name) AS real_name,
  CASE WHEN regexp_matches(phone, {PHONE_SQL}) THEN md5(phone) END AS phone_num,
  CASE WHEN regexp_matches(mail, {EMAIL_SQL}) THEN md5(mail) END AS email,
  DATE '1970-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS birthday, DATE '2000-01-01' + CAST(c_custkey % 300 AS INTEGER) AS start_date,
  DATE '9999-12-31' AS end_date
FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN '138' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE '12' || CAST(c_custkey AS VARCHAR) END AS phone,
  CASE WHEN c_custkey % 2 = 0 THEN 'u' || CAST(c_custkey AS VARCHAR) || '@mail.example' ELSE 'none' END AS mail FROM customer)
""")
def l06_user(spark, sf):
    k = F.col("c_custkey")
    users = a.table(spark, sf, "customer").select(
        k.alias("id"), F.col("c_mktsegment").alias("passwd"), F.col("c_name").alias("real_name"),
        F.when(k % 3 == 0, F.concat(F.lit("138"), F.lpad(k.cast("string"), 8, "0"))).otherwise(F.concat(F.lit("12"), k)).alias("phone_num"),
        F.when(k % 2 == 0, F.concat(F.lit("u"), k, F.lit("@mail.example"))).otherwise("none").alias("email"),
        (k % 20000).alias("birthday"), F.date_add(a.day("2000-01-01"), (k % 300).cast("int")).alias("create_time"),
    )
    return lg.user_history(users)


@query("l06_address_history", f"""
SELECT o_orderkey AS id, o_custkey AS user_id,
  CASE WHEN regexp_matches(phone, {PHONE_SQL}) THEN md5(phone) END AS phone, CAST(o_orderdate AS DATE) AS start_date, DATE '9999-12-31' AS end_date
FROM (SELECT *, '1' || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS phone FROM orders)
""")
def l06_address(spark, sf):
    phone = F.concat(F.lit("1"), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"))
    rows = a.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), phone.alias("phone"), F.col("o_orderdate").alias("create_time")
    )
    return lg.address_history(rows)


# -- summaries ------------------------------------------------------------------------

ORG_ORDERS = """
oo AS (
  SELECT org_id, org_name, p.sender_district_id AS city_id, n_name AS city_name, cargo_type, cargo_type_name, dt,
         count(*) AS order_count, CAST(sum(amount) AS DECIMAL(26,2)) AS order_amount
  FROM (SELECT order_id, cargo_type, cargo_type_name, sender_district_id, order_day AS dt, max(amount) AS amount
        FROM parcels GROUP BY ALL) p
  LEFT JOIN organs ON sender_district_id = region_id LEFT JOIN nation ON sender_district_id = n_nationkey GROUP BY ALL)"""


def _org_orders(spark, sf, days=None):
    return lg.org_cargo_orders_1d(_step("order", ["cargo_type"], True)(spark, sf, days), a.organs(spark, sf), a.places(spark, sf))


@query("l07_org_cargo_orders_1d", with_(PARCELS, ORGANS, ORG_ORDERS) + "SELECT * FROM oo")
def l07(spark, sf):
    return _org_orders(spark, sf)


def _nd(source: str, keys: str, measures: dict[str, str], horizons: str = "(7), (30)") -> str:
    cols = ", ".join(f"CAST(sum({m}) AS {k}) AS {m}" for m, k in measures.items())
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY recent_days{', ' + keys if keys else ''}"
    return f"""SELECT {lead}recent_days, {cols} FROM {source} s CROSS JOIN (VALUES {horizons}) h(recent_days)
WHERE s.dt > {SHOP_DAY} - recent_days AND s.dt <= {SHOP_DAY} {group}"""


COUNT_AMOUNT = {"order_count": "BIGINT", "order_amount": "DECIMAL(26,2)"}
CARGO_KEYS = ["org_id", "org_name", "city_id", "city_name", "cargo_type", "cargo_type_name"]


@query("l07_org_cargo_orders_nd", with_(PARCELS, ORGANS, ORG_ORDERS) + _nd("oo", ", ".join(CARGO_KEYS), COUNT_AMOUNT))
def l07_nd(spark, sf):
    return lg.recent_days(_org_orders(spark, sf, _recent()), CARGO_KEYS, list(COUNT_AMOUNT), _day())


def _org_step(name: str, district: str, cond: str, amount: bool = True) -> str:
    money = ", CAST(sum(amount) AS DECIMAL(26,2)) AS order_amount" if amount else ""
    return f"""
{name} AS (
  SELECT org_id, org_name, city_id, city_name, province_id, province_name, dt, count(*) AS order_count{money}
  FROM (SELECT order_id, {district} AS district, update_day AS dt, max(amount) AS amount FROM parcels WHERE {cond} GROUP BY ALL) p
  LEFT JOIN organs ON district = region_id LEFT JOIN places ON district = district_id GROUP BY ALL)"""


RECEIVE = _org_step("receive", "sender_district_id", NOT_IN["receive"])
DELIVER = _org_step("deliver", "receiver_district_id", NOT_IN["deliver"], amount=False)


def _receive(spark, sf, days=None):
    return lg.org_step_1d(_step("receive", [], True)(spark, sf, days), a.organs(spark, sf), a.places(spark, sf), "sender_district_id")


def _deliver(spark, sf, days=None):
    return lg.org_step_1d(_step("deliver", [], True)(spark, sf, days), a.organs(spark, sf), a.places(spark, sf), "receiver_district_id", with_amount=False)


@query("l08_org_receive_1d", with_(PARCELS, ORGANS, PLACES, RECEIVE) + "SELECT * FROM receive")
def l08_receive(spark, sf):
    return _receive(spark, sf)


PLACE = ", ".join(lg.PLACE)


@query("l08_org_receive_nd", with_(PARCELS, ORGANS, PLACES, RECEIVE) + _nd("receive", PLACE, COUNT_AMOUNT))
def l08_receive_nd(spark, sf):
    return lg.recent_days(_receive(spark, sf, _recent()), lg.PLACE, list(COUNT_AMOUNT), _day())


DISPATCH = f"""
dispatch AS (SELECT dt, count(*) AS order_count, CAST(sum(amount) AS DECIMAL(26,2)) AS order_amount
  FROM (SELECT order_id, update_day AS dt, max(amount) AS amount FROM parcels WHERE {NOT_IN["dispatch"]} GROUP BY ALL) GROUP BY 1)"""


def _dispatch(spark, sf, days=None):
    return lg.dispatch_1d(_step("dispatch", [], True)(spark, sf, days))


@query("l08_dispatch_1d", with_(PARCELS, DISPATCH) + "SELECT * FROM dispatch")
def l08_dispatch(spark, sf):
    return _dispatch(spark, sf)


@query("l08_dispatch_nd", with_(PARCELS, DISPATCH) + _nd("dispatch", "", COUNT_AMOUNT))
def l08_dispatch_nd(spark, sf):
    return lg.recent_days(_dispatch(spark, sf, _recent()), [], list(COUNT_AMOUNT), _day())


TD = f"""
dtd AS (SELECT CAST(sum(order_count) AS BIGINT) AS order_count, CAST(sum(order_amount) AS DECIMAL(36,2)) AS order_amount FROM dispatch),
btd AS (SELECT count(*) AS order_count, CAST(sum(amount) AS DECIMAL(36,2)) AS order_amount
        FROM (SELECT order_id, max(amount) AS amount FROM parcels WHERE {NOT_IN["bound_finish"]} GROUP BY 1))"""


@query("l08_dispatch_td", with_(PARCELS, DISPATCH, TD) + "SELECT * FROM dtd")
def l08_dispatch_td(spark, sf):
    return lg.dispatch_to_date(_dispatch(spark, sf))


@query("l08_bound_finish_td", with_(PARCELS, DISPATCH, TD) + "SELECT * FROM btd")
def l08_bound_td(spark, sf):
    return lg.step_to_date(_step("bound_finish", [], True)(spark, sf))


TRUCKS = """
tt AS (SELECT org_id, org_name, truck_model_type, truck_model_type_name, dt, count(*) AS trans_finish_count,
       CAST(sum(dist) AS DECIMAL(26,2)) AS trans_finish_distance, CAST(sum(dur) AS BIGINT) AS trans_finish_dur_sec FROM tasks GROUP BY ALL)"""


def _truck_daily(spark, sf, days=None):
    return lg.org_truck_transport_1d(a.transports(spark, sf, days), a.trucks(spark, sf))


@query("l09_org_truck_transport_1d", with_(TASKS, TRUCKS) + "SELECT * FROM tt")
def l09(spark, sf):
    return _truck_daily(spark, sf)


SHIFT_ND = f"""
snd AS (
  SELECT shift_id, CASE WHEN org_level = 1 THEN o.region_id ELSE city_id END AS city_id,
         CASE WHEN org_level = 1 THEN district_name ELSE city_name END AS city_name, t.org_id, t.org_name, line_id,
         'line ' || CAST(shift_id % 10 AS VARCHAR) AS line_name, driver1_emp_id, driver1_name, driver2_emp_id, driver2_name,
         truck_model_type, truck_model_type_name, recent_days, count(*) AS trans_finish_count,
         CAST(sum(dist) AS DECIMAL(26,2)) AS trans_finish_distance, CAST(sum(dur) AS BIGINT) AS trans_finish_dur_sec,
         CAST(sum(order_num) AS BIGINT) AS trans_finish_order_count
  FROM tasks t LEFT JOIN organs o ON t.org_id = o.org_id LEFT JOIN places ON o.region_id = district_id
  CROSS JOIN (VALUES (7), (30)) h(recent_days)
  WHERE t.dt > {SHOP_DAY} - recent_days AND t.dt <= {SHOP_DAY} GROUP BY ALL)"""
S4 = (TASKS, ORGANS, PLACES, SHIFT_ND)


def _shift_nd(spark, sf):
    return lg.shift_transport_nd(
        a.transports(spark, sf, _recent()), a.organs(spark, sf), a.places(spark, sf), a.shift_lines(spark, sf), a.trucks(spark, sf), _day()
    )


@query("l09_shift_transport_nd", with_(*S4) + "SELECT * FROM snd")
def l09_shift(spark, sf):
    return _shift_nd(spark, sf)


@query("l10_org_deliver_1d", with_(PARCELS, ORGANS, PLACES, DELIVER) + "SELECT * FROM deliver")
def l10_deliver(spark, sf):
    return _deliver(spark, sf)


@query("l10_org_deliver_nd", with_(PARCELS, ORGANS, PLACES, DELIVER) + _nd("deliver", PLACE, {"order_count": "BIGINT"}))
def l10_deliver_nd(spark, sf):
    return lg.recent_days(_deliver(spark, sf, _recent()), lg.PLACE, ["order_count"], _day())


SORT = """
sorts AS (
  SELECT s.org_id, org_name,
    CASE WHEN org_level = 1 THEN district_id ELSE city_id END AS city_id, CASE WHEN org_level = 1 THEN district_name ELSE city_name END AS city_name,
    CASE WHEN org_level = 1 THEN city_id ELSE province_id END AS province_id, CASE WHEN org_level = 1 THEN city_name ELSE province_name END AS province_name,
    sort_count, dt
  FROM (SELECT s_nationkey + 1000 AS org_id, CAST(l_shipdate AS DATE) AS dt, count(*) AS sort_count
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber > 2 GROUP BY 1, 2) s
  LEFT JOIN organs o ON s.org_id = o.org_id LEFT JOIN places ON region_id = district_id)"""


def _sort(spark, sf, days=None):
    sorts = lg.bound_fact(_scans(spark, sf, days), "sort_time", "sorter_emp_id", days)
    return lg.org_sort_1d(sorts, a.organs(spark, sf), a.places(spark, sf))


@query("l10_org_sort_1d", with_(ORGANS, PLACES, SORT) + "SELECT * FROM sorts")
def l10_sort(spark, sf):
    return _sort(spark, sf)


@query("l10_org_sort_nd", with_(ORGANS, PLACES, SORT) + _nd("sorts", PLACE, {"sort_count": "BIGINT"}))
def l10_sort_nd(spark, sf):
    return lg.recent_days(_sort(spark, sf, _recent()), lg.PLACE, ["sort_count"], _day())


# -- reports --------------------------------------------------------------------------

H3 = "(1), (7), (30)"


def _report_sql(parts: dict[str, tuple[str, dict[str, tuple[str, str]]]], keys: str) -> str:
    """Full joins of rolled sources: label -> (source, {output: (measure, type)})."""
    names = ["recent_days"] + ([k.strip() for k in keys.split(",")] if keys else [])
    ctes, outs = [], []
    for label, (source, measures) in parts.items():
        cols = ", ".join(f"CAST(sum({m}) AS {k}) AS {o}" for o, (m, k) in measures.items())
        outs += list(measures)
        ctes.append(
            f"r_{label} AS (SELECT {', '.join(names)}, {cols} FROM {source} s CROSS JOIN (VALUES {H3}) h(recent_days) "
            f"WHERE s.dt > {SHOP_DAY} - recent_days AND s.dt <= {SHOP_DAY} GROUP BY {', '.join(names)})"
        )
    labels = [f"r_{x}" for x in parts]
    joined = labels[0] + "".join(f" FULL JOIN {x} USING ({', '.join(names)})" for x in labels[1:])
    return ", " + ", ".join(ctes) + f" SELECT {SHOP_DAY} AS dt, {', '.join(names + outs)} FROM {joined}"


C, M = "BIGINT", "DECIMAL(36,2)"


@query("l11_receive_dispatch_report", with_(PARCELS, ORGANS, PLACES, RECEIVE, DISPATCH) + _report_sql({
    "receive": ("receive", {"receive_order_count": ("order_count", C), "receive_order_amount": ("order_amount", M)}),
    "dispatch": ("dispatch", {"dispatch_order_count": ("order_count", C), "dispatch_order_amount": ("order_amount", M)}),
}, ""))
def l11(spark, sf):
    return lg.receive_dispatch_report(_receive(spark, sf, _recent()), _dispatch(spark, sf, _recent()), _day())


TRANS = {"trans_finish_count": ("trans_finish_count", C), "trans_finish_distance": ("trans_finish_distance", M), "trans_finish_dur_sec": ("trans_finish_dur_sec", C)}
ORD = {"order_count": ("order_count", C), "order_amount": ("order_amount", M)}


@query("l12_transport_totals", with_(TASKS, TRUCKS) + _report_sql({"t": ("tt", TRANS)}, ""))
def l12_transport(spark, sf):
    return lg.totals_report(_truck_daily(spark, sf, _recent()), lg.TRANSPORT, _day())


@query("l12_order_totals", with_(PARCELS, ORGANS, ORG_ORDERS) + _report_sql({"o": ("oo", ORD)}, ""))
def l12_orders(spark, sf):
    return lg.totals_report(_org_orders(spark, sf, _recent()), list(COUNT_AMOUNT), _day())


@query("l12_cargo_type_totals", with_(PARCELS, ORGANS, ORG_ORDERS) + _report_sql({"o": ("oo", ORD)}, "cargo_type, cargo_type_name"))
def l12_cargo(spark, sf):
    return lg.totals_report(_org_orders(spark, sf, _recent()), list(COUNT_AMOUNT), _day(), ["cargo_type", "cargo_type_name"])


@query("l13_in_transit", with_(PARCELS, DISPATCH, TD) + """
SELECT CAST(d.order_count - b.order_count AS BIGINT) AS bounding_order_count, CAST(d.order_amount - b.order_amount AS DECIMAL(38,2)) AS bounding_order_amount
FROM dtd d, btd b
""")
def l13(spark, sf):
    return lg.in_transit_report(l08_dispatch_td(spark, sf), l08_bound_td(spark, sf))


MEANS = """SELECT *, CASE WHEN trans_finish_count > 0 THEN CAST(trans_finish_distance AS DOUBLE) / trans_finish_count END AS avg_trans_finish_distance,
CASE WHEN trans_finish_count > 0 THEN CAST(trans_finish_dur_sec AS DOUBLE) / trans_finish_count END AS avg_trans_finish_dur_sec FROM ("""

CITY_TRANS = """
ct AS (SELECT CASE WHEN org_level = 1 THEN district_id ELSE city_id END AS city_id, CASE WHEN org_level = 1 THEN district_name ELSE city_name END AS city_name, tt.*
       FROM tt JOIN organs o ON tt.org_id = o.org_id JOIN places ON region_id = district_id)"""


def _wrap(ctes: str, body: str) -> str:
    """Put the mean columns around the final select of a report."""
    head, tail = body.rsplit(" SELECT DATE", 1)
    return ctes + head + " " + MEANS + "SELECT DATE" + tail + ")"


@query("l14_city_report", _wrap(with_(PARCELS, ORGANS, PLACES, ORG_ORDERS, TASKS, TRUCKS, CITY_TRANS),
       _report_sql({"o": ("oo", ORD), "t": ("ct", TRANS)}, "city_id, city_name")))
def l14_city(spark, sf):
    trans = lg.transports_with_city(_truck_daily(spark, sf, _recent()), a.organs(spark, sf), a.places(spark, sf))
    return lg.place_report(_org_orders(spark, sf, _recent()), trans, ["city_id", "city_name"], _day())


@query("l14_org_report", _wrap(with_(PARCELS, ORGANS, ORG_ORDERS, TASKS, TRUCKS),
       _report_sql({"o": ("oo", ORD), "t": ("tt", TRANS)}, "org_id, org_name")))
def l14_org(spark, sf):
    return lg.place_report(_org_orders(spark, sf, _recent()), _truck_daily(spark, sf, _recent()), ["org_id", "org_name"], _day())


@query("l15_shift_report", with_(*S4) + f"""
SELECT {SHOP_DAY} AS dt, recent_days, shift_id, trans_finish_count, trans_finish_distance, trans_finish_dur_sec, trans_finish_order_count FROM snd
""")
def l15_shift(spark, sf):
    return lg.shift_report(_shift_nd(spark, sf), _day())


SUMS = f"""CAST(sum(trans_finish_count) AS {C}) AS trans_finish_count, CAST(sum(trans_finish_distance) AS {M}) AS trans_finish_distance,
CAST(sum(trans_finish_dur_sec) AS {C}) AS trans_finish_dur_sec"""


@query("l15_line_report", with_(*S4) + f"""
SELECT {SHOP_DAY} AS dt, recent_days, line_id, line_name, {SUMS}, CAST(sum(trans_finish_order_count) AS {C}) AS trans_finish_order_count
FROM snd GROUP BY ALL
""")
def l15_line(spark, sf):
    return lg.line_report(_shift_nd(spark, sf), _day())


@query("l16_driver_report", with_(*S4) + f"""
, d AS (
  SELECT recent_days, driver1_emp_id AS driver_emp_id, driver1_name AS driver_name, trans_finish_count AS n,
         CAST(trans_finish_distance AS DOUBLE) / CASE WHEN driver2_emp_id IS NULL THEN 1 ELSE 2 END AS km,
         CAST(trans_finish_dur_sec AS DOUBLE) / CASE WHEN driver2_emp_id IS NULL THEN 1 ELSE 2 END AS sec FROM snd
  UNION ALL SELECT recent_days, driver2_emp_id, driver2_name, trans_finish_count, CAST(trans_finish_distance AS DOUBLE) / 2,
         CAST(trans_finish_dur_sec AS DOUBLE) / 2 FROM snd WHERE driver2_emp_id IS NOT NULL)
SELECT {SHOP_DAY} AS dt, recent_days, driver_emp_id, driver_name, CAST(sum(n) AS BIGINT) AS trans_finish_count, sum(km) AS trans_finish_distance,
       sum(sec) AS trans_finish_dur_sec, sum(km) / sum(n) AS avg_trans_finish_distance, sum(sec) / sum(n) AS avg_trans_finish_dur_sec
FROM d GROUP BY recent_days, driver_emp_id, driver_name
""")
def l16(spark, sf):
    return lg.driver_report(_shift_nd(spark, sf), _day())


@query("l17_truck_report", with_(*S4) + MEANS + f"""
SELECT {SHOP_DAY} AS dt, recent_days, truck_model_type, truck_model_type_name, {SUMS} FROM snd GROUP BY ALL)
""")
def l17(spark, sf):
    return lg.truck_report(_shift_nd(spark, sf), _day())


EXPRESS = (PARCELS, ORGANS, PLACES, RECEIVE, DELIVER, SORT)
DEL = {"deliver_suc_count": ("order_count", C)}
SRT = {"sort_count": ("sort_count", C)}
REC = {"receive_order_count": ("order_count", C), "receive_order_amount": ("order_amount", M)}


@query("l18_express_totals", with_(*EXPRESS) + _report_sql({"d": ("deliver", DEL), "s": ("sorts", SRT)}, ""))
def l18(spark, sf):
    return lg.express_report(_deliver(spark, sf, _recent()), _sort(spark, sf, _recent()), None, [], _day())


def _express(level: str):
    keys = [f"{level}_id", f"{level}_name"]

    @query(f"l18_express_by_{level}", with_(*EXPRESS) + _report_sql(
        {"d": ("deliver", DEL), "s": ("sorts", SRT), "r": ("receive", REC)}, ", ".join(keys)))
    def run(spark, sf):
        return lg.express_report(_deliver(spark, sf, _recent()), _sort(spark, sf, _recent()), _receive(spark, sf, _recent()), keys, _day())


for _level in ("province", "city", "org"):
    _express(_level)


@query("l18_deliver_all_levels", with_(PARCELS, ORGANS, PLACES, DELIVER) + """
SELECT province_id, city_id, org_id, CAST(GROUPING(province_id, city_id, org_id) AS BIGINT) AS level, CAST(sum(order_count) AS BIGINT) AS order_count
FROM deliver GROUP BY ROLLUP (province_id, city_id, org_id)
""")
def l18_levels(spark, sf):
    return lg.all_levels(_deliver(spark, sf), ["province_id", "city_id", "org_id"], ["order_count"])


@query("jon03_full_join_of_steps", with_(PARCELS, ORGANS, PLACES, RECEIVE, DELIVER) + """
SELECT org_id, dt, r.n AS received, d.n AS delivered
FROM (SELECT org_id, dt, CAST(sum(order_count) AS BIGINT) AS n FROM receive GROUP BY 1, 2) r
FULL JOIN (SELECT org_id, dt, CAST(sum(order_count) AS BIGINT) AS n FROM deliver GROUP BY 1, 2) d USING (org_id, dt)
""")
def jon03(spark, sf):
    def per(df, name):
        return df.groupBy("org_id", "dt").agg(F.sum("order_count").alias(name))

    return align({"r": per(_receive(spark, sf), "received"), "d": per(_deliver(spark, sf), "delivered")}, ["org_id", "dt"])
