"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
``load`` is the time to stage the tables and build the whole warehouse; the queries then run
on the stored warehouse, each once after one warm-up of the session, into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "D11_scd2_merge", "F01_fact_transactions", "F08_agg_customer_monthly", "F09_agg_product_daily",
    "V03_referential_integrity", "E06_run_all_rules", "S11_column_profile", "K07_average_order_value",
    "K08_month_over_month", "K10_revenue_by_segment", "K17_channel_conversion",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tillstar.catalog import QUERIES, Context
    from tillstar.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, app="bench", memory=os.environ.get("BENCH_MEMORY", "8g"))
    names = sorted(n for n in QUERIES if n.startswith("Q")) + list(HEADLINE)
    seconds: dict[str, float] = {}

    began = time.monotonic()
    Context(spark, folder).tables  # builds staging and warehouse
    seconds["load"] = round(time.monotonic() - began, 3)

    QUERIES[names[0]](spark, folder).write.format("noop").mode("overwrite").save()
    for name in names:
        began = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "warehouse_load_and_queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
