"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up, then ``BENCH_RUNS`` times (2); the best time counts. Results are
computed in full and thrown away by the ``noop`` sink. ``BENCH_QUERIES`` picks names, ``all`` means
every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusmill.catalog import QUERIES  # noqa: E402
from corpusmill.session import build_session  # noqa: E402

HEADLINE = [
    "scan_report", "funnel_summary", "reject_rows", "valid_rows", "dedupe_sha1", "clean_caption", "pair_sidecar",
    "manifest_lenient", "resume_anti", "shard_assign", "manifest_build", "manifest_integrity",
    "training_draws", "gather_samples", "training_table", "epoch_batches", "q_sample", "mse_by_t", "denoise_eval",
    "log_parse", "loss_ema", "loss_describe", "shard_coverage", "step_seconds", "cache_retention",
    "ckpt_diff", "ckpt_keys", "stream_ingest_counts", "stream_dedupe",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split() or HEADLINE
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    }
    # The folder a cluster names is kept; a local run gets one of its own.
    if not os.environ.get("BENCH_KEEP_CHECKPOINT_DIR"):
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times[1:] or times), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
