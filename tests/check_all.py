"""Compare every registered query with its SQL: ``python tests/check_all.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
import traceback

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from compare import differences, oracle  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from corpusmill.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session(
        "check", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = oracle(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            found = differences(df, con, sql) if sql else [] if df.count() else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}", traceback.format_exc()[-700:] if os.environ.get("TRACE") else ""]
        failed += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - started:.2f}s", *found, sep="\n     " if found else " ", flush=True)
    print("failed:", failed, "of", len(names))
    spark.stop()


if __name__ == "__main__":
    main()
