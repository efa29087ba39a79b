"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from ledgerline.plans import catalogue
from ledgerline.session import local_session, table

HEADLINE = [
    "snapshot_diff",
    "snapshot_diff_dup_keys",
    "delta_apply_roundtrip",
    "change_feed_diff",
    "index_rollforward",
    "row_tally",
    "greedy_batches",
    "attachment_diff",
    "verdict_items",
    "typed_properties",
    "page_scan",
    "element_tally",
    "wkb_encode",
]


def seconds(run) -> float:
    began = time.time()
    run().write.format("noop").mode("overwrite").save()
    return round(time.time() - began, 3)


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        query = catalogue.QUERIES[name]
        seconds(lambda: query(spark, folder))  # compiles code and warms the file cache
        times[name] = seconds(lambda: query(spark, folder))
    rows = {"snapshot_diff": table(spark, folder, "orders").count(), "snapshot_diff_dup_keys": table(spark, folder, "lineitem").count()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": {name: int(n / times[name]) for name, n in rows.items()},
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
