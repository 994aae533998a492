"""Time the load and the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the number of local cores. `load_*` entries build and
write the tables; the other queries run over the loaded tables and are consumed row by row, without output.
"""

from __future__ import annotations

import json
import os
import time

from freightlens import registry
from freightlens.session import get_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

LOADS = ["clean", "order_totals", "customer_totals", "staging", "dims", "fact"]
QUERIES = [
    "vw_executive_overview", "vw_monthly_sales_trend", "vw_category_performance", "vw_product_performance",
    "vw_customer_performance", "vw_customer_segment_summary", "vw_market_performance", "vw_order_summary",
    "vw_order_item_detail",
    "a1_q05", "a1_q10", "a2_q01", "a2_q06", "a2_q09", "a2_q10", "a3_q02", "a3_q04", "a3_q06", "a3_q10", "a4_q01", "a4_q04",
    "a4_q08", "a4_q09", "a5_q03", "a5_q04", "a5_q08", "a5_q09",
    "dq_02_volume_unique", "dq_10_financial_features", "dq_15_readiness", "fact_orphans", "fact_reconcile",
    "eda_market_tables", "eda_loss_tables", "eda_correlation", "val_aggregate_features",
]


def main() -> None:
    spark = get_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    w = registry.warehouse(spark, FOLDER)
    for table in LOADS:
        timed(f"load_{table}", lambda: getattr(w, table))
    for name in QUERIES:
        timed(name, lambda: registry.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save())
    rows = w.fact.count()
    scale = FOLDER.rstrip("/").rsplit("/sf", 1)[-1]
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_time", "value": total, "unit": "sec", "queries": times, "sf": scale, "fact_rows": rows}))


if __name__ == "__main__":
    main()
