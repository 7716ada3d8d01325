"""Headline timings: one JSON line. ``BENCH_SF_DIR``, ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import build_session  # noqa: E402
from workload import views  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "latest_changes",
    "latest_changes_bulk",
    "latest_change_ids",
    "dedup_batch",
    "dedup_snapshot",
    "table_status",
    "window_changes",
    "all_documents",
    "unchanged_documents",
    "merge_snapshot",
    "merge_snapshot_late",
    "merge_all_live",
    "merge_partitioned_log",
    "merge_bulk",
    "merge_bulk_late",
    "merge_repeated_prior",
    "extract_intrinsics",
    "decode_payloads",
    "scan_snapshot_keys",
    "write_snapshot",
    "copy_unmodified",
    "append_change_log",
    "generate_snapshot",
    "generate_snapshot_by_shuffle",
    "generate_snapshot_all_live",
    "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='tidemark-bench-')}",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # files that several queries read are made before the clock starts
    for fixture in (views.event_log, views.document_log, views.customer_root, views.landing):
        fixture(spark, sf_dir)
    # class loading and code generation are not the queries' doing
    for name in names[:3]:
        run(name)
    timings = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "sum of headline query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
