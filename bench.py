"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

import json
import os
import time

import pyarrow.parquet as pq

from roundhaul.plans.queries import QUERIES
from roundhaul.session import build_session

HEADLINES = (
    "load_statistics",
    "total_rows",
    "inventory_join",
    "table_inventory",
    "profile_columns",
    "conform_types",
    "order_pricing",
    "timestamp_ms_text",
    "export_form",
    "write_read_roundtrip",
    "partition_identity",
    "partition_day",
    "day_range_scan",
    "read_as_of",
    "statistics_match",
    "float_tolerance",
    "content_match",
    "content_diff",
    "keyed_diff",
    "audit_unique",
    "audit_foreign_key",
    "evolve_append",
    "migrate_report",
    "restore_report",
    "full_cycle",
    "labelled_counts",
    "differing_rows",
    "replaced_load",
    "restore_roundtrip",
    "partial_reload",
    "change_feed",
    "load_difference",
    "validity_history",
    "profile_range",
    "clustered_range",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "roundhaul-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["row_count"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    names = ("customer", "part", "orders", "lineitem", "events")
    rows = {name: pq.read_metadata(f"{sf_dir}/{name}.parquet").num_rows for name in names}
    moved = sum(rows.values())
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "rows_per_sec": {
            "write_and_read": round(rows["lineitem"] / seconds["write_read_roundtrip"]),
            "order_pricing": round(rows["lineitem"] / seconds["order_pricing"]),
            "content_diff": round(2 * rows["orders"] / seconds["content_diff"]),
            "migrate": round(moved / seconds["migrate_report"]),
            "full_cycle": round(moved / seconds["full_cycle"]),
        },
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
