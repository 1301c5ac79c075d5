"""Parcel logistics: facts, dimensions, summaries and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions import text
from saltmarsh.functions.dates import OPEN_END, epoch_day, in_days, millis_to_text
from saltmarsh.operators.history import open_history
from saltmarsh.operators.horizons import HORIZONS, horizon_sums, unfold
from saltmarsh.operators.relations import align, climb, dealt, decode, net_balance

# Order states that a step excludes ("not") or requires ("in").
STEP_STATES = {
    "order": ("not", []),
    "pay": ("not", ["60010", "60999"]),
    "cancel": ("in", ["60020"]),
    "receive": ("not", ["60010", "60020", "60999"]),
    "dispatch": ("not", ["60010", "60020", "60030", "60040", "60999"]),
    "bound_finish": ("not", ["60020", "60030", "60040", "60050"]),
    "deliver": ("not", ["60020", "60030", "60040"]),
    "sign": ("not", ["60020", "60030", "60040", "60050"]),
}
FINAL_STATES = ["60020", "60030"]

ORDER_COLUMNS = [
    "order_no", "status", "collect_type", "payment_type", "user_id",
    "receiver_complex_id", "receiver_province_id", "receiver_city_id", "receiver_district_id",
    "sender_complex_id", "sender_province_id", "sender_city_id", "sender_district_id",
    "cargo_num", "amount", "distance", "update_time",
]
CARGO_COLUMNS = ["id", "order_id", "cargo_type", "volume_length", "volume_width", "volume_height", "weight"]


def _alive(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_deleted").cast("string") == "0") if "is_deleted" in df.columns else df


CODES = ("cargo_type", "status", "collect_type", "payment_type")
Days = tuple[Column, Column]  # first and last day


def _within(df: DataFrame, column: str, days: Days | None) -> DataFrame:
    return df if days is None else df.filter(in_days(df, column, *days))


def order_step_fact(
    cargo: DataFrame, orders: DataFrame, dictionary: DataFrame, step: str, codes: Sequence[str] = CODES, days: Days | None = None,
    spread: bool = False,
) -> DataFrame:
    """Cargo lines of orders that have reached a step, masked and with ``codes`` decoded.

    The first step ("order") is dated by the order time, the others by the last
    update.  The status filter runs before the join; with ``days``, a range on
    the raw time column of the step does, too, and prunes its scan.  With
    ``spread`` the lines are dealt by order for a summary that groups them by it.
    """
    mode, states = STEP_STATES[step]
    rows = _alive(orders)
    if step == "order":
        cargo = _within(cargo, "create_time", days)
    else:
        rows = _within(rows, "update_time", days)
    if states:
        inside = F.col("status").cast("string").isin(*states)
        rows = rows.filter(inside if mode == "in" else ~inside)
    have = [c for c in ORDER_COLUMNS if c in orders.columns]
    info = rows.select(
        F.col("id").alias("_oid"),
        *have,
        *[text.mask_name(F.col(c)).alias(c) for c in ("receiver_name", "sender_name") if c in orders.columns],
        *(
            [millis_to_text(F.col("estimate_arrive_time")).alias("estimate_arrive_time")]
            if "estimate_arrive_time" in orders.columns
            else []
        ),
    )
    lines = _alive(cargo).select(
        *[c for c in CARGO_COLUMNS if c in cargo.columns],
        F.date_format(F.col("create_time").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("order_time"),
    )
    lines = dealt(lines, "order_id") if spread else lines
    out = lines.join(info, F.col("order_id") == F.col("_oid"), "inner").drop("_oid")
    for code in codes:
        if code in out.columns:
            out = decode(out, dictionary, code, f"{code}_name", missing="", code_column="id", name_column="name")
    moment = "order_time" if step == "order" else "update_time"
    return out.withColumn("dt", F.col(moment).cast("date"))


def order_process_fact(cargo: DataFrame, orders: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Accumulating fact: open until the order reaches a final state."""
    out = order_step_fact(cargo, orders, dictionary, "order")
    final = F.col("status").cast("string").isin(*FINAL_STATES)
    end = F.when(final, F.col("update_time").cast("date")).otherwise(F.lit(OPEN_END).cast("date"))
    return out.withColumn("start_date", F.col("order_time").cast("date")).withColumn("end_date", end).withColumn(
        "dt", F.col("end_date")
    )


def transport_finish_fact(tasks: DataFrame, shifts: DataFrame | None = None, days: Days | None = None) -> DataFrame:
    """Finished transport tasks with duration, masked drivers and hashed plate; of ``days`` by their end, if given."""
    done = _within(_alive(tasks).filter(F.col("actual_end_time").isNotNull()), "actual_end_time", days)
    start, end = F.col("actual_start_time").cast("long"), F.col("actual_end_time").cast("long")
    masked = {
        c: text.mask_name(F.col(c)) for c in ("driver1_name", "driver2_name") if c in tasks.columns
    }
    out = done.withColumn("finish_dur_sec", F.floor((end - start) / 1000).cast("long")).withColumn(
        "dt", F.timestamp_millis(end).cast("date")
    )
    out = out.withColumns(
        {
            **masked,
            "truck_no": text.pseudonym(F.col("truck_no")),
            "actual_start_time": millis_to_text(start),
            "actual_end_time": millis_to_text(end),
        }
    )
    if shifts is not None:
        side = shifts.select(
            F.col("id").alias("_s"), *[c for c in ("estimated_time",) if c in shifts.columns]
        )
        out = out.join(side, F.col("shift_id") == F.col("_s"), "left").drop("_s")
    return out


def bound_fact(scans: DataFrame, moment: str, emp: str, days: Days | None = None) -> DataFrame:
    """Inbound, sort or outbound scans, of ``days`` if given: ``moment`` is the epoch-millis column."""
    return _within(scans.filter(F.col(moment).isNotNull()), moment, days).select(
        "id", "order_id", "org_id",
        millis_to_text(F.col(moment)).alias(moment), emp,
        F.timestamp_millis(F.col(moment).cast("long")).cast("date").alias("dt"),
    )


# -- dimensions --------------------------------------------------------------


def _name_of(df: DataFrame, side: DataFrame, on: str, columns: dict[str, str], how: str = "left") -> DataFrame:
    s = _alive(side).select(F.col("id").alias("_id"), *[F.col(v).alias(k) for k, v in columns.items()])
    return df.join(s, F.col(on) == F.col("_id"), how).drop("_id")


def complex_dimension(complexes: DataFrame, regions: DataFrame, courier_complex: DataFrame) -> DataFrame:
    couriers = _alive(courier_complex).groupBy(F.col("complex_id").alias("_c")).agg(
        F.sort_array(F.collect_set(F.col("courier_emp_id").cast("string"))).alias("courier_emp_ids")
    )
    out = _name_of(_alive(complexes), regions, "province_id", {"province_name": "name"}, "inner")
    out = _name_of(out, regions, "city_id", {"city_name": "name"}, "inner")
    return (
        out.join(couriers, F.col("id") == F.col("_c"), "left")
        .drop("_c")
        .withColumn("courier_emp_ids", F.coalesce("courier_emp_ids", F.array().cast("array<string>")))
    )


def organ_dimension(organs: DataFrame, regions: DataFrame) -> DataFrame:
    out = _name_of(_alive(organs), regions, "region_id", {"region_name": "name", "region_code": "dict_code"})
    out = _name_of(out, organs, "org_parent_id", {"org_parent_name": "org_name"})
    return out.fillna("", ["region_name", "region_code", "org_parent_name"])


def region_dimension(regions: DataFrame) -> DataFrame:
    return _alive(regions).select("id", "parent_id", "name", "dict_code", "short_name")


def courier_dimension(couriers: DataFrame, organs: DataFrame, dictionary: DataFrame) -> DataFrame:
    out = _name_of(_alive(couriers), organs, "org_id", {"org_name": "org_name"}, "inner")
    out = _name_of(out, dictionary, "express_type", {"express_type_name": "name"}, "inner")
    return out.withColumn("working_phone", text.pseudonym(F.col("working_phone")))


def shift_dimension(shifts: DataFrame, lines: DataFrame, dictionary: DataFrame) -> DataFrame:
    columns = {
        "line_name": "name", **{c: c for c in (
            "line_no", "line_level", "org_id", "transport_line_type_id", "start_org_id", "start_org_name",
            "end_org_id", "end_org_name", "pair_line_id", "distance", "cost", "estimated_time",
        ) if c in lines.columns},
    }
    out = _name_of(_alive(shifts), lines, "line_id", columns, "inner")
    return _name_of(out, dictionary, "transport_line_type_id", {"transport_line_type_name": "name"}, "inner")


def driver_dimension(drivers: DataFrame, teams: DataFrame, organs: DataFrame) -> DataFrame:
    out = _name_of(_alive(drivers), organs, "org_id", {"org_name": "org_name"}, "inner")
    out = _name_of(out, teams, "team_id", {"team_name": "name"}, "inner")
    return out.withColumn("license_no", text.pseudonym(F.col("license_no")))


def truck_dimension(
    trucks: DataFrame, teams: DataFrame, models: DataFrame, organs: DataFrame, dictionary: DataFrame
) -> DataFrame:
    team = {"team_name": "name", "team_no": "team_no", "org_id": "org_id", "manager_emp_id": "manager_emp_id"}
    model = {
        "truck_model_name": "model_name", "truck_model_type": "model_type", "truck_model_no": "model_no",
        "truck_brand": "brand",
        **{c: c for c in (
            "truck_weight", "load_weight", "total_weight", "eev", "boxcar_len", "boxcar_wd", "boxcar_hg",
            "max_speed", "oil_vol",
        ) if c in models.columns},
    }
    out = _name_of(_alive(trucks), teams, "team_id", team, "inner")
    out = _name_of(out, models, "truck_model_id", model, "inner")
    out = _name_of(out, organs, "org_id", {"org_name": "org_name"}, "inner")
    out = _name_of(out, dictionary, "truck_model_type", {"truck_model_type_name": "name"}, "inner")
    out = _name_of(out, dictionary, "truck_brand", {"truck_brand_name": "name"}, "inner")
    return out.withColumn("truck_no", text.pseudonym(F.col("truck_no")))


def user_history(users: DataFrame) -> DataFrame:
    """Hashed personal data, epoch-day birthday, open history."""
    out = _alive(users).withColumns(
        {
            "passwd": text.pseudonym(F.col("passwd")),
            "real_name": text.pseudonym(F.col("real_name")),
            "phone_num": text.pseudonym(F.col("phone_num"), text.PHONE_PATTERN),
            "email": text.pseudonym(F.col("email"), text.EMAIL_PATTERN),
            "birthday": epoch_day(F.col("birthday")),
        }
    )
    return open_history(out, F.col("create_time").cast("date")).drop("create_time")


def address_history(addresses: DataFrame) -> DataFrame:
    out = _alive(addresses).withColumn("phone", text.pseudonym(F.col("phone"), text.PHONE_PATTERN))
    return open_history(out, F.col("create_time").cast("date")).drop("create_time")


# -- summaries ---------------------------------------------------------------


def _one_per_order(detail: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An order counts once per day and place, with its largest amount."""
    return detail.groupBy("order_id", *keys, "dt").agg(F.max("amount").alias("_amount"))


def _organ(organs: DataFrame, on: str) -> DataFrame:
    return organs.select(F.col("id").alias("org_id"), "org_name", F.col("region_id").alias(on))


def org_cargo_orders_1d(detail: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Orders and amount by organisation, city and cargo type."""
    keys = ["cargo_type", "cargo_type_name", "sender_district_id", "sender_city_id"]
    by_place = _one_per_order(detail, keys).groupBy(*keys, "dt").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_amount").alias("_a")
    )
    org = _organ(organs, "_district")
    city = regions.select(F.col("id").alias("city_id"), F.col("name").alias("city_name"))
    joined = by_place.join(org, F.col("sender_district_id") == F.col("_district"), "left").join(
        city, F.col("sender_city_id") == F.col("city_id"), "left"
    )
    return joined.groupBy(
        "org_id", "org_name", F.col("sender_city_id").alias("city_id"), "city_name", "cargo_type", "cargo_type_name", "dt"
    ).agg(F.sum("_n").alias("order_count"), F.sum("_a").alias("order_amount"))


PLACE = ["org_id", "org_name", "city_id", "city_name", "province_id", "province_name"]


def _org_places(organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Each organisation of a district with its city and province."""
    org = organs.select(F.col("id").alias("org_id"), "org_name", F.col("region_id").alias("district_id"))
    return climb(org, regions, "district_id", ["_d", "city", "province"]).drop("_d_id", "_d_name")


def org_step_1d(
    detail: DataFrame, organs: DataFrame, regions: DataFrame, district: str, with_amount: bool = True
) -> DataFrame:
    """Orders of a step (received, delivered) by organisation with city and province.

    Counting happens per district before the place dimension is joined.
    """
    base = detail if with_amount else detail.withColumn("amount", F.lit(0).cast("decimal(16,2)"))
    per = _one_per_order(base, [district]).groupBy(district, "dt").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_amount").alias("_a")
    )
    places = _org_places(organs, regions)
    joined = per.join(places, F.col(district) == F.col("district_id"), "left")
    aggs = [F.sum("_n").alias("order_count")] + ([F.sum("_a").alias("order_amount")] if with_amount else [])
    return joined.groupBy(*PLACE, "dt").agg(*aggs)


def dispatch_1d(detail: DataFrame) -> DataFrame:
    return _one_per_order(detail, []).groupBy("dt").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("_amount").alias("order_amount")
    )


def step_to_date(detail: DataFrame) -> DataFrame:
    """Orders and amount of a step over all days, each order once."""
    return detail.groupBy("order_id").agg(F.max("amount").alias("_a")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("_a").alias("order_amount")
    )


def dispatch_to_date(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def org_sort_1d(sorts: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Sort scans by organisation; level-1 organisations sit in a city, others in a district."""
    per = sorts.groupBy("org_id", "dt").agg(F.count(F.lit(1)).alias("sort_count"))
    org = organs.select(F.col("id").alias("_o"), "org_name", "org_level", "region_id")
    up = climb(per.join(org, F.col("org_id") == F.col("_o"), "left"), regions, "region_id", ["a", "b", "c"])
    top = F.col("org_level") == 1

    def pick(near: str, far: str) -> Column:
        return F.when(top, F.col(near)).otherwise(F.col(far))

    return up.select(
        "org_id", "org_name",
        pick("a_id", "b_id").alias("city_id"), pick("a_name", "b_name").alias("city_name"),
        pick("b_id", "c_id").alias("province_id"), pick("b_name", "c_name").alias("province_name"),
        "sort_count", "dt",
    )


TRANSPORT = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]


def _transport_sums() -> list[Column]:
    return [
        F.count("id").alias("trans_finish_count"),
        F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"),
    ]


def org_truck_transport_1d(transports: DataFrame, trucks: DataFrame) -> DataFrame:
    truck = trucks.select(F.col("id").alias("_t"), "truck_model_type", "truck_model_type_name")
    return (
        transports.join(truck, F.col("truck_id") == F.col("_t"), "left")
        .groupBy(
            F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"),
            "truck_model_type", "truck_model_type_name", "dt",
        )
        .agg(*_transport_sums())
    )


SHIFT_KEYS = [
    "shift_id", "line_id", "start_org_id", "start_org_name", "driver1_emp_id", "driver1_name",
    "driver2_emp_id", "driver2_name", "truck_id",
]


def shift_transport_nd(
    transports: DataFrame, organs: DataFrame, regions: DataFrame, shifts: DataFrame, trucks: DataFrame,
    as_of: Column, horizons: Sequence[int] = (7, 30),
) -> DataFrame:
    """Trips, distance, time and parcels per shift and crew for 7 and 30 days."""
    measures = {
        "trans_finish_count": F.lit(1).cast("long"),
        "trans_finish_distance": F.col("actual_distance"),
        "trans_finish_dur_sec": F.col("finish_dur_sec"),
        "trans_finish_order_count": F.col("order_num"),
    }
    wide = horizon_sums(transports, SHIFT_KEYS, "dt", as_of, measures, horizons)
    rows = unfold(wide, SHIFT_KEYS, list(measures), horizons).filter(F.col("trans_finish_count") > 0)
    org = organs.select(F.col("id").alias("_o"), "org_level", "region_id")
    named = climb(rows.join(org, F.col("start_org_id") == F.col("_o"), "left"), regions, "region_id", ["a", "b"])
    line = shifts.select(F.col("id").alias("_s"), "line_name")
    truck = trucks.select(F.col("id").alias("_t"), "truck_model_type", "truck_model_type_name")
    named = named.join(line, F.col("shift_id") == F.col("_s"), "left").join(
        truck, F.col("truck_id") == F.col("_t"), "left"
    )
    top = F.col("org_level") == 1
    return named.select(
        "shift_id",
        F.when(top, F.col("a_id")).otherwise(F.col("b_id")).alias("city_id"),
        F.when(top, F.col("a_name")).otherwise(F.col("b_name")).alias("city_name"),
        F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"),
        "line_id", "line_name", "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name",
        "truck_model_type", "truck_model_type_name", "recent_days", *measures,
    )


def recent_days(daily: DataFrame, keys: Sequence[str], measures: Sequence[str], as_of: Column, horizons=(7, 30)) -> DataFrame:
    """A day summary over its last n days; groups without rows in a horizon are absent."""
    sums = {m: F.col(m) for m in measures}
    sums["_days"] = F.lit(1)
    wide = horizon_sums(daily, keys, "dt", as_of, sums, horizons)
    return unfold(wide, keys, list(sums), horizons).filter(F.col("_days") > 0).drop("_days")


# -- reports -----------------------------------------------------------------


def _report(rows: DataFrame, as_of: Column) -> DataFrame:
    return rows.select(as_of.alias("dt"), *rows.columns)


def by_place(
    parts: dict[str, tuple[DataFrame, dict[str, str]]], keys: Sequence[str], as_of: Column, horizons=HORIZONS
) -> DataFrame:
    """Several day summaries side by side per horizon and place.

    ``parts`` maps a label to (day summary, {output: source measure}).  The same
    function serves the total, province, city and organisation level by ``keys``.
    """
    rolled = {}
    for label, (daily, measures) in parts.items():
        named = daily.select(*keys, "dt", *[F.col(src).alias(out) for out, src in measures.items()])
        rolled[label] = recent_days(named, keys, list(measures), as_of, horizons)
    return _report(align(rolled, ["recent_days", *keys]), as_of)


def receive_dispatch_report(receive: DataFrame, dispatch: DataFrame, as_of: Column) -> DataFrame:
    return by_place(
        {
            "receive": (receive, {"receive_order_count": "order_count", "receive_order_amount": "order_amount"}),
            "dispatch": (dispatch, {"dispatch_order_count": "order_count", "dispatch_order_amount": "order_amount"}),
        },
        [], as_of,
    )


def totals_report(daily: DataFrame, measures: Sequence[str], as_of: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Transport totals, order totals and cargo-type totals."""
    return _report(recent_days(daily, list(keys), measures, as_of, HORIZONS), as_of)


def in_transit_report(dispatched_td: DataFrame, finished_td: DataFrame) -> DataFrame:
    """Orders dispatched but not yet bound-finished."""
    out = net_balance(dispatched_td, finished_td, [], ["order_count", "order_amount"])
    return out.select(
        F.col("order_count").alias("bounding_order_count"), F.col("order_amount").alias("bounding_order_amount")
    )


def with_means(df: DataFrame) -> DataFrame:
    """Mean distance and seconds per trip."""
    trips = F.col("trans_finish_count")
    return df.withColumns(
        {
            "avg_trans_finish_distance": F.when(trips > 0, F.col("trans_finish_distance").cast("double") / trips),
            "avg_trans_finish_dur_sec": F.when(trips > 0, F.col("trans_finish_dur_sec").cast("double") / trips),
        }
    )


def place_report(orders: DataFrame, transports: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """City or organisation: orders beside transport with means per trip."""
    return with_means(
        by_place(
            {
                "orders": (orders, {"order_count": "order_count", "order_amount": "order_amount"}),
                "transport": (transports, {m: m for m in TRANSPORT}),
            },
            keys, as_of,
        )
    )


def transports_with_city(daily: DataFrame, organs: DataFrame, regions: DataFrame) -> DataFrame:
    """Organisation transport with the organisation's city."""
    org = organs.select(F.col("id").alias("_o"), "org_level", "region_id")
    up = climb(daily.join(org, F.col("org_id") == F.col("_o")), regions, "region_id", ["a", "b"])
    top = F.col("org_level") == 1
    return up.withColumn("city_id", F.when(top, F.col("a_id")).otherwise(F.col("b_id"))).withColumn(
        "city_name", F.when(top, F.col("a_name")).otherwise(F.col("b_name"))
    ).select(*daily.columns, "city_id", "city_name")


def shift_report(shift_nd: DataFrame, as_of: Column) -> DataFrame:
    return _report(shift_nd.select("recent_days", "shift_id", *TRANSPORT, "trans_finish_order_count"), as_of)


def _sum_report(shift_nd: DataFrame, keys: Sequence[str], measures: Sequence[str], as_of: Column) -> DataFrame:
    return _report(
        shift_nd.groupBy("recent_days", *keys).agg(*[F.sum(m).alias(m) for m in measures]), as_of
    )


def line_report(shift_nd: DataFrame, as_of: Column) -> DataFrame:
    return _sum_report(shift_nd, ["line_id", "line_name"], [*TRANSPORT, "trans_finish_order_count"], as_of)


def truck_report(shift_nd: DataFrame, as_of: Column) -> DataFrame:
    return with_means(_sum_report(shift_nd, ["truck_model_type", "truck_model_type_name"], TRANSPORT, as_of))


def driver_report(shift_nd: DataFrame, as_of: Column) -> DataFrame:
    """Per driver; a crew of two shares distance and time by half, trips count whole."""
    pair = F.col("driver2_emp_id").isNotNull()
    first, second = (
        F.struct(F.col(f"driver{i}_emp_id").alias("driver_emp_id"), F.col(f"driver{i}_name").alias("driver_name"))
        for i in (1, 2)
    )
    crew = F.when(pair, F.array(first, second)).otherwise(F.array(first))
    share = F.when(pair, F.lit(2)).otherwise(F.lit(1))
    one_each = shift_nd.select(
        "recent_days",
        F.explode(crew).alias("_driver"),
        "trans_finish_count",
        (F.col("trans_finish_distance").cast("double") / share).alias("trans_finish_distance"),
        (F.col("trans_finish_dur_sec").cast("double") / share).alias("trans_finish_dur_sec"),
    ).select("recent_days", "_driver.*", *TRANSPORT)
    return with_means(_sum_report(one_each, ["driver_emp_id", "driver_name"], TRANSPORT, as_of))


def express_report(
    deliver: DataFrame, sort: DataFrame, receive: DataFrame | None, keys: Sequence[str], as_of: Column
) -> DataFrame:
    """Delivered, sorted and (below the total) received parcels at one place level."""
    parts = {
        "deliver": (deliver, {"deliver_suc_count": "order_count"}),
        "sort": (sort, {"sort_count": "sort_count"}),
    }
    if receive is not None:
        parts["receive"] = (
            receive, {"receive_order_count": "order_count", "receive_order_amount": "order_amount"}
        )
    return by_place(parts, keys, as_of)


def all_levels(daily: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The measure at every prefix of ``keys`` (total, province, city, ...) in one roll-up."""
    return daily.rollup(*keys).agg(
        F.grouping_id().alias("level"), *[F.sum(m).alias(m) for m in measures]
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
