"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from terrazzo.catalog import QUERIES  # noqa: E402
from terrazzo.session import build_session  # noqa: E402

HEADLINES = [
    "silver_sales",
    "silver_housing",
    "silver_crime",
    "silver_incomes",
    "agg_count",
    "agg_room_shares",
    "agg_surface_shares",
    "agg_quantiles",
    "gold_sales",
    "gold_fact",
    "report_kpi",
    "report_kpi_city",
    "report_typology",
    "report_price_history",
    "report_map_prices",
    "report_data_table",
    "report_composite",
    "window_yearly_change",
    "contract_duplicate_keys",
    "latest_per_key",
    "stream_latest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "terrazzo-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the executor threads and compile the reader before the clock runs
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
