"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR   table directory (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default: all)
BENCH_QUERIES  comma list of query names, or "all" for every batch query
"""

from __future__ import annotations

import json
import os
import time

from saltmarsh.queries import all_entries
from saltmarsh.session import build_session

HEADLINE = [
    "f01_order_detail_fact", "f03_paid_detail_fact", "f04_trade_flow", "f06_page_view_fact", "d01_sku_dimension",
    "d04_history_from_changes", "s01_province_order_1d", "s06_user_order_1d", "s09_user_sku_order_1d", "s10_user_sku_order_nd",
    "m03_orders_by_province", "m08_order_stats_by_category", "m11_page_path", "m12_repeat_purchase_by_brand",
    "m13_top_cart_skus_by_category", "m15_traffic_by_channel", "m18_user_retention", "l01_receive_fact", "l07_org_cargo_orders_1d",
    "l09_shift_transport_nd", "l14_city_report", "l18_express_by_city", "w02_product_efficiency", "w09_hot_products",
    "w12_product_scores", "w17_page_scores", "t11_moderation", "t15_profile_best_band", "t18_overview", "t20_top_products",
    "stm14_newer_only", "jon11_interval_join", "jon13_as_of_lookup", "win03_global_rank",
]


def run(spark, entry, folder: str) -> float:
    start = time.perf_counter()
    entry.run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    entries = all_entries()
    wanted = os.environ.get("BENCH_QUERIES", "")
    if wanted == "all":
        names = [n for n in entries if not n.startswith("stream_")]
    else:
        names = [n for n in wanted.split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else os.cpu_count(),
        extra={
            "spark.ui.enabled": "false", "spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    seconds: dict[str, float] = {}
    for name in names:
        run(spark, entries[name], folder)  # warm the file cache and the compiled code
        seconds[name] = round(run(spark, entries[name], folder), 3)
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
