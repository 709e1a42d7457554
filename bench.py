"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkload.queries import QUERIES
from sparkload.session import build_session

HEADLINE = (
    "cast_orders_rejects",
    "cast_lineitem",
    "cast_events_pgsql",
    "copy_text_encode",
    "copy_text_roundtrip",
    "delimited_roundtrip",
    "sqlite_scan",
    "pk_violations",
    "pk_violation_rows",
    "fk_orphans",
    "fk_composite_orphans",
    "child_parent_join",
    "pk_range_shards",
    "compare_tables",
    "compare_fingerprints",
    "compare_by_key",
    "collect_line_parts",
    "route_partition_range",
    "money_to_numeric",
    "wkt_to_geometry",
    "resolve_casts",
    "load_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["tinyint_to_bool"](spark, sf_dir).collect()  # start-up is not part of any query
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "cast_lineitem_rows_per_sec": round(rows / seconds["cast_lineitem"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
