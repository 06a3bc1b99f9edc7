"""Three operators against their single-task form on $BENCH_SF_DIR, local[$BENCH_CPUS]; one JSON line.

Ordinal (M1): a window without partitions. Average (W2): one group per event type in pandas. Dedupe
(U1): a window over the hash. ``BENCH_RUNS`` timed runs (3) after one to warm up; the best counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from corpusmill.operators import curation, ordered  # noqa: E402
from corpusmill.session import build_session  # noqa: E402


def _pandas_ema(pdf):
    pdf = pdf.sort_values("event_id")
    pdf["ema"] = pdf["value"].ewm(alpha=0.02, adjust=False).mean()
    return pdf[["event_id", "ema"]]


def forms(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "value")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    hashed = docs.select("doc_id", F.sha1("text").alias("h"))
    single = Window.orderBy("event_id")
    first = F.row_number().over(Window.partitionBy("h").orderBy("doc_id"))
    return {
        "ordinal": lambda: ordered.with_ordinal(events.select("event_id"), ["event_id"]),
        "ordinal_single_task": lambda: events.select("event_id", F.row_number().over(single).alias("ordinal")),
        "ema": lambda: ordered.ema(events, "value", ["event_id"], ["event_type"]),
        "ema_task_per_group": lambda: events.groupBy("event_type").applyInPandas(_pandas_ema, "event_id bigint, ema double"),
        "dedupe": lambda: curation.keepers(hashed, "h", "doc_id"),
        "dedupe_window": lambda: hashed.withColumn("rn", first).filter("rn = 1"),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench-forms", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, form in forms(spark, sf_dir).items():
        times = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3")) + 1):
            started = time.perf_counter()
            form().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times[1:]), 3)
    spark.stop()
    print(json.dumps({"forms": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
