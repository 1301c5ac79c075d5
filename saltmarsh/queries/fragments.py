"""Common table expressions of the reference SQL, written apart from the Spark code."""

SHOP_DAY = "DATE '2001-07-31'"
EVENT_DAY = "DATE '2024-01-30'"

DETAIL = """
detail AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
         c_nationkey AS province_id, CAST(l_shipdate AS DATE) AS dt, CAST(l_quantity AS BIGINT) AS sku_num,
         CAST(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(16,2)) AS DECIMAL(16,2)) AS orig,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_discount AS DECIMAL(16,2)) ELSE 0 END AS act,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_tax AS DECIMAL(16,2)) ELSE 0 END AS cou,
         CAST(l_extendedprice AS DECIMAL(16,2)) AS total
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
)"""

SKU = """
sku AS (
  SELECT p_partkey AS sku, p_name AS sku_name, substr(p_type, 1, 1) AS category1_id, p_type AS category2_id,
         p_type || '-' || CAST(p_size AS VARCHAR) AS category3_id, p_brand AS tm_id, lower(p_brand) AS tm_name
  FROM part
)"""

HORIZONS = "(VALUES (1), (7), (30)) h(recent_days)"

PAYMENTS = """
payments AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, substr(o_orderpriority, 1, 1) AS payment_type,
         first_ship AS callback_time, CAST(o_totalprice AS DECIMAL(16,2)) AS amount
  FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1) s
    ON o_orderkey = l_orderkey
  WHERE o_orderstatus <> 'O'
)"""

VIEWS = """
views AS (
  SELECT user_id, user_id AS mid_id, CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         event_type AS page_id, event_type AS channel, CAST(ts AS DATE) AS dt, ts, event_id,
         CAST(value AS DECIMAL(16,2)) AS during_time
  FROM events
)"""

BEHAVIOUR = """
behaviour AS (
  SELECT user_id, CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         user_id % 10 AS store_id, event_id % 20 AS item_id,
         CASE event_type WHEN 'click' THEN 'item_list' WHEN 'view' THEN 'item_detail' WHEN 'signup' THEN 'home'
              WHEN 'error' THEN 'search_result' ELSE 'content' END AS page_type,
         CASE event_type WHEN 'purchase' THEN 'payment' WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'search'
              WHEN 'signup' THEN 'payment_success' ELSE 'view' END AS event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS search_rank,
         CAST(floor(value) AS INTEGER) AS duration,
         CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS is_new_customer,
         CAST(event_id % 2 AS INTEGER) AS repurchase_flag,
         CAST(value AS DECIMAL(10,2)) AS acquisition_cost,
         1 AS page_count, CAST(ts AS DATE) AS dt, ts, event_id
  FROM events
)"""

ORGANS = """
organs AS (
  SELECT n_nationkey + 1000 AS org_id, 'ORG_' || n_name AS org_name,
         CASE WHEN n_regionkey % 2 = 0 THEN 1 ELSE 2 END AS org_level, n_nationkey AS region_id, n_regionkey
  FROM nation
)"""

# nation (district) -> region (city) -> group of regions (province)
PLACES = """
places AS (
  SELECT n_nationkey AS district_id, n_name AS district_name, r_regionkey + 100 AS city_id, r_name AS city_name,
         r_regionkey % 2 + 200 AS province_id, 'TOP_' || CAST(r_regionkey % 2 AS VARCHAR) AS province_name
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

PARCELS = """
parcels AS (
  SELECT l_orderkey AS order_id, l_orderkey * 10 + l_linenumber AS id, l_returnflag AS cargo_type,
         'cargo ' || l_returnflag AS cargo_type_name,
         CASE o_orderstatus WHEN 'F' THEN '60070' WHEN 'P' THEN '60050'
              ELSE CASE WHEN o_orderkey % 2 = 0 THEN '60030' ELSE '60020' END END AS status,
         c_nationkey AS sender_district_id, CAST(o_orderkey % 25 AS INTEGER) AS receiver_district_id,
         CAST(o_totalprice AS DECIMAL(16,2)) AS amount, CAST(l_shipdate AS DATE) AS order_day,
         CAST(o_orderdate AS DATE) AS update_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
)"""

TASKS = """
tasks AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey % 50 AS shift_id, l_partkey % 10 AS line_id,
         s_nationkey + 1000 AS org_id, 'ORG_NATION_' || CAST(s_nationkey AS VARCHAR) AS org_name,
         l_suppkey AS driver1_emp_id, 'd*' AS driver1_name,
         CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey + 1 END AS driver2_emp_id,
         CASE WHEN l_linenumber % 2 = 0 THEN 'd*' END AS driver2_name,
         l_suppkey AS truck_id, s_nationkey % 3 AS truck_model_type,
         'model ' || CAST(s_nationkey % 3 AS VARCHAR) AS truck_model_type_name,
         CAST(l_quantity AS DECIMAL(16,2)) AS dist, CAST(l_quantity AS BIGINT) * 60 AS dur,
         CAST(l_linenumber AS BIGINT) AS order_num, l_shipdate AS ship,
         CAST(l_shipdate + CAST(l_quantity AS BIGINT) * INTERVAL 1 MINUTE AS DATE) AS dt
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def ratio(numerator: str, denominator: str, scale: int = 2) -> str:
    """Half-up quotient of counts in integer arithmetic."""
    f = 2 * 10**scale
    return (
        f"CASE WHEN {denominator} > 0 THEN CAST((({numerator}) * {f} + ({denominator})) // (2 * ({denominator})) "
        f"AS DECIMAL(18,0)) * CAST({1 / 10**scale} AS DECIMAL({scale + 1},{scale})) END"
    )


def percent(numerator: str, denominator: str) -> str:
    below = f"greatest(coalesce({denominator}, 1), 1)"
    return f"CAST((coalesce({numerator}, 0) * 20000 + {below}) // (2 * {below}) AS DOUBLE) / 100.0"
