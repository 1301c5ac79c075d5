"""Splitting one stream into typed facts.

Every fact is a projection of the parsed stream, so it can be used on batch
frames, on a stream of its own, or inside one ``foreachBatch`` that writes all
routes of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions.documents import LOG_RECORD, parse_records
from saltmarsh.streaming.inputs import AVAILABLE_NOW, row_image

Router = dict[str, Callable[[DataFrame], DataFrame]]


def parse_logs(df: DataFrame, column: str = "value") -> DataFrame:
    """Log records; ``is_dirty`` marks broken JSON and records without the ``common`` part."""
    rows = parse_records(df, column, LOG_RECORD)
    return rows.withColumn("is_dirty", F.col("is_dirty") | (F.col(column).isNotNull() & F.col("rec.common").isNull()))


def _good(logs: DataFrame) -> DataFrame:
    return logs.filter(~F.col("is_dirty"))


def _actions() -> Column:
    return F.coalesce(F.col("rec.actions"), F.col("rec.action"))


def _common(*pairs: tuple[str, str]) -> list[Column]:
    return [F.col(f"rec.common.{src}").alias(new) for src, new in pairs]


WHO = [("mid", "mid"), ("uid", "user_id")]


def start_log(logs: DataFrame) -> DataFrame:
    return _good(logs).filter(F.col("rec.start").isNotNull()).select(
        *_common(*WHO, ("ch", "channel"), ("is_new", "is_new")),
        F.col("rec.start.entry").alias("start_type"), F.col("rec.start.loading_time").alias("loading_time"),
        F.col("rec.ts").alias("ts"),
    )


def page_log(logs: DataFrame) -> DataFrame:
    return _good(logs).filter(F.col("rec.page").isNotNull()).select(
        *_common(*WHO, ("ch", "channel"), ("is_new", "is_new")),
        *[F.col(f"rec.page.{c}").alias(c) for c in ("page_id", "last_page_id", "item", "item_type", "during_time")],
        F.col("rec.ts").alias("ts"),
    )


def action_log(logs: DataFrame) -> DataFrame:
    """One row per action; older records use the name ``action``."""
    return _good(logs).select(*_common(*WHO), F.explode(_actions()).alias("_a")).select(
        "mid", "user_id", "_a.action_id", "_a.item", "_a.item_type", "_a.ts"
    )


def display_log(logs: DataFrame) -> DataFrame:
    return _good(logs).select(
        *_common(*WHO), F.col("rec.page.page_id").alias("page_id"), F.col("rec.ts").alias("ts"),
        F.explode("rec.displays").alias("_d"),
    ).select("mid", "user_id", "_d.*", "ts", "page_id")


def error_log(logs: DataFrame) -> DataFrame:
    return _good(logs).filter(F.col("rec.err").isNotNull()).select(
        *_common(*WHO), F.col("rec.err.error_code").alias("err_code"), F.col("rec.err.msg").alias("err_msg"),
        F.col("rec.ts").alias("ts"),
    )


def unknown_log(logs: DataFrame, column: str = "value") -> DataFrame:
    """Well-formed records without any known part."""
    empty = (
        F.col("rec.start").isNull() & F.col("rec.page").isNull() & F.col("rec.displays").isNull()
        & F.col("rec.err").isNull() & _actions().isNull()
    )
    return _good(logs).filter(empty).select(column)


def dirty(rows: DataFrame, column: str = "value") -> DataFrame:
    return rows.filter(F.col("is_dirty")).select(column)


LOG_ROUTES: Router = {
    "start": start_log, "page": page_log, "action": action_log, "display": display_log,
    "error": error_log, "unknown": unknown_log, "dirty": dirty,
}


@dataclass(frozen=True)
class ChangeFact:
    """Projection of one source table: new column -> "field:type"."""

    table: str
    columns: Mapping[str, str]
    condition: Callable[[], Column] | None = None
    inserts_only: bool = False

    def matches(self) -> Column:
        out = ~F.col("is_dirty") & (F.col("table") == self.table)
        if self.condition is not None:
            out &= self.condition()
        if self.inserts_only:
            out &= F.col("op").isin("c", "r")
        return out

    def __call__(self, changes: DataFrame) -> DataFrame:
        out = []
        for new, spec in self.columns.items():
            field, _, kind = spec.partition(":")
            value = row_image()[field]
            out.append((value.try_cast(kind) if kind else value).alias(new))
        return changes.filter(self.matches()).select(*out, F.col("ts_ms").alias("ts"))


def _equals(field: str, code: str) -> Callable[[], Column]:
    return lambda: row_image()[field] == code


MONEY = "decimal(16,2)"

# Source tables, status codes and fields of the change facts.
CHANGE_ROUTES: Router = {
    "order_detail": ChangeFact("order_detail", {
        "id": "id", "order_id": "order_id", "user_id": "user_id", "sku_id": "sku_id", "sku_name": "sku_name",
        "sku_num": "sku_num:int", "split_original_amount": f"order_price:{MONEY}",
        "split_activity_amount": f"split_activity_amount:{MONEY}",
        "split_coupon_amount": f"split_coupon_amount:{MONEY}",
        "split_total_amount": f"split_total_amount:{MONEY}", "create_time": "create_time:bigint",
    }),
    "cart_add": ChangeFact("cart_info", {"id": "id", "user_id": "user_id", "sku_id": "sku_id", "sku_num": "sku_num:int"}),
    "order_cancel": ChangeFact("order_info", {
        "id": "id", "user_id": "user_id", "cancel_time": "operate_time:bigint",
        "split_total_amount": f"total_amount:{MONEY}",
    }, _equals("order_status", "1003")),
    "payment_success": ChangeFact("payment_info", {
        "id": "id", "order_id": "order_id", "user_id": "user_id", "payment_type": "payment_type",
        "callback_time": "callback_time:bigint", "split_payment_amount": f"total_amount:{MONEY}",
    }, _equals("payment_status", "1603")),
    "order_refund": ChangeFact("order_refund_info", {
        "id": "id", "order_id": "order_id", "user_id": "user_id", "sku_id": "sku_id",
        "refund_num": "refund_num:int", "refund_amount": f"refund_amount:{MONEY}", "create_time": "create_time:bigint",
    }),
    "comment": ChangeFact("comment_info", {
        "id": "id", "user_id": "user_id", "sku_id": "sku_id", "order_id": "order_id", "appraise": "appraise",
        "comment_txt": "comment_txt", "create_time": "create_time:bigint",
    }),
    "coupon_get": ChangeFact("coupon_use", {
        "id": "id", "user_id": "user_id", "coupon_id": "coupon_id", "get_time": "get_time:bigint",
    }, _equals("coupon_status", "1401")),
    "coupon_use": ChangeFact("coupon_use", {
        "id": "id", "user_id": "user_id", "coupon_id": "coupon_id", "order_id": "order_id",
    }, _equals("coupon_status", "1402")),
    "user_register": ChangeFact("user_info", {
        "id": "id", "login_name": "login_name", "register_time": "create_time:bigint", "province_id": "province_id",
    }, inserts_only=True),
}
FACT_TABLES = [
    "order_detail", "cart_info", "order_info", "payment_info", "order_refund_info", "comment_info", "coupon_use", "user_info",
]


def unrouted_changes(changes: DataFrame, dimension_tables: list[str], column: str = "value") -> DataFrame:
    """Well-formed changes of tables that are neither facts nor dimensions."""
    known = F.coalesce(F.col("table").isin(*FACT_TABLES, *dimension_tables), F.lit(False))
    return changes.filter(~F.col("is_dirty") & ~known).select(column)


def complete_change_routes(dimension_tables: list[str]) -> Router:
    """The fact routes with the channels ``dirty`` and ``unrouted`` beside them."""
    return {**CHANGE_ROUTES, "dirty": dirty, "unrouted": lambda rows: unrouted_changes(rows, dimension_tables)}


def change_route(dimension_tables: list[str]) -> Column:
    """The one place of a change.

    ``dirty``, the name of its fact, ``dimension``, ``unused`` (a fact table's
    record that no fact takes) or ``unrouted``; a null record is ``unrouted``.
    """
    out = F.when(F.col("is_dirty"), "dirty")
    for name, fact in CHANGE_ROUTES.items():
        out = out.when(fact.matches(), name)
    if dimension_tables:
        out = out.when(F.col("table").isin(*dimension_tables), "dimension")
    return out.when(F.col("table").isin(*FACT_TABLES), "unused").otherwise("unrouted")


def cart_add_delta(changes: DataFrame) -> DataFrame:
    """Added quantity: the snapshot value, or the increase of an update."""
    after = F.col("after")["sku_num"].try_cast("int")
    before = F.col("before")["sku_num"].try_cast("int")
    rows = changes.filter(~F.col("is_dirty") & (F.col("table") == "cart_info"))
    rows = rows.filter((F.col("op") == "r") | ((F.col("op") == "u") & (after > before)))
    added = F.when(F.col("op") == "r", after).otherwise(after - before)
    return rows.select(
        *[F.col("after")[c].alias(c) for c in ("id", "user_id", "sku_id")], added.alias("sku_num"),
        F.col("ts_ms").alias("ts"),
    )


# The six raw shop-traffic logs and their time and visitor fields.
SHOP_LOGS = {
    "user_visit_log": ("visit_time", "visitor_id"),
    "product_interaction_log": ("interact_time", "visitor_id"),
    "order_pay_log": ("pay_time", "buyer_id"),
    "search_log": ("search_time", "visitor_id"),
    "page_click_log": ("click_time", "visitor_id"),
    "crowd_attribute_log": ("update_time", "visitor_id"),
}


def shop_log(changes: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    """Rows of one raw shop log with typed columns (name -> type)."""
    rows = changes.filter(~F.col("is_dirty") & (F.col("table") == table)).withColumn("_row", row_image())
    return rows.select(*[F.col("_row")[c].try_cast(kind).alias(c) for c, kind in columns.items()], "op", "ts_ms")


def shop_log_route() -> Column:
    """Name of the raw shop log of a change, else ``dirty`` or ``unrouted``.

    A record of a shop log without a row image (an unknown operation) is dirty.
    """
    known = F.col("table").isin(*SHOP_LOGS)
    broken = F.col("is_dirty") | (known & ~F.coalesce(F.col("op").isin("c", "r", "u", "d") & row_image().isNotNull(), F.lit(False)))
    return F.when(broken, "dirty").when(known, F.col("table")).otherwise("unrouted")


def shop_log_rows(changes: DataFrame, column: str = "value") -> DataFrame:
    """Every change with its route and, for shop logs, the row as JSON, its visitor and its time."""
    def field(at: int) -> Column:
        names = F.create_map(*[F.lit(x) for table, fields in SHOP_LOGS.items() for x in (table, fields[at])])
        return F.when(F.col("route").isin(*SHOP_LOGS), F.try_element_at(row_image(), F.try_element_at(names, F.col("route"))))

    rows = changes.withColumn("route", shop_log_route())
    image = F.when(F.col("route").isin(*SHOP_LOGS), F.to_json(row_image()))
    return rows.select("route", column, "op", image.alias("row"), field(1).alias("visitor_id"), field(0).try_cast("bigint").alias("log_time"))


def route_records(rows: DataFrame, route: Column | str, path: str, checkpoint: str, kind: str = "parquet", trigger: Mapping = AVAILABLE_NOW):
    """Start one query that writes each record to exactly one folder ``path/route=<name>``.

    The file sink commits a micro-batch as a whole, so a replay changes nothing.
    Read the folder back with its schema: routes that got no record have no folder.
    """
    return (
        rows.withColumn("route", route if isinstance(route, Column) else F.col(route))
        .writeStream.format(kind).partitionBy("route").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def write_routes(batch: DataFrame, batch_id: int, routes: Router, path: str, kind: str = "json") -> None:
    """Write every route of one micro-batch below ``path/<route>/batch_id=<n>``.

    The directory of a batch is overwritten, so a replayed batch changes nothing.
    """
    batch.persist()
    try:
        for name, route in routes.items():
            route(batch).write.mode("overwrite").format(kind).save(f"{path}/{name}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def route_stream(parsed: DataFrame, routes: Router, path: str, checkpoint: str, kind: str = "json", trigger: Mapping = AVAILABLE_NOW):
    """Start one query that writes all routes of a parsed stream."""
    return (
        parsed.writeStream.foreachBatch(lambda b, i: write_routes(b, i, routes, path, kind))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
