"""Run time over the number of partitions and over table sizes.

    python -m bench.sweep partitions key_families 1 4 16 64
    python -m bench.sweep scale key_families /root/testdata/sf0.01 /root/testdata/sf0.1
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Sequence

from pyspark.sql import SparkSession

from rideloom.plans import all_queries
from rideloom.plans.tables import Tables
from rideloom.session import build_session


def _seconds(spark: SparkSession, query: str, sf_dir: str) -> tuple[float, int]:
    """Second of two runs, and the rows of the result."""
    taken = 0.0
    for _ in range(2):
        start = time.perf_counter()
        rows = all_queries()[query](spark, sf_dir).count()
        taken = time.perf_counter() - start
    return round(taken, 3), rows


def partition_sweep(spark: SparkSession, query: str, sf_dir: str, ks: Sequence[int]) -> list[dict]:
    """The query with k shuffle partitions, AQE coalescing off so that k is what runs."""
    out = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for k in ks:
        spark.conf.set("spark.sql.shuffle.partitions", str(k))
        seconds, rows = _seconds(spark, query, sf_dir)
        out.append({"k": k, "rows": rows, "seconds": seconds})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return out


def scale_curve(spark: SparkSession, query: str, sf_dirs: Sequence[str]) -> list[dict]:
    """The query over tables of growing size, with the number of input events."""
    out = []
    for sf_dir in sf_dirs:
        seconds, rows = _seconds(spark, query, sf_dir)
        events = Tables(spark, sf_dir).events.count()
        out.append({"sf": os.path.basename(sf_dir), "events": events, "rows": rows, "seconds": seconds})
    return out


def main(kind: str, query: str, *values: str) -> None:
    spark = build_session("sweep", f"local[{os.environ.get('BENCH_CPUS', '8')}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("OFF")
    if kind == "partitions":
        rows = partition_sweep(spark, query, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), list(map(int, values)))
    else:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        rows = scale_curve(spark, query, values)
    for row in rows:
        print(json.dumps({"query": query, **row}))


if __name__ == "__main__":
    main(*sys.argv[1:])
