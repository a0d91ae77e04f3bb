"""Time the monthly job on N million text lines made from the events table.

    python -m bench.scale [copies] [cpus]

The lines are written once as CSV shards to a new folder; only the job that reads them is timed.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import functions as F

from rideloom.plans.tables import MONTH, RULES, Tables
from rideloom.schema import RAW_FIELDS
from rideloom.session import build_session
from rideloom.sources import publish, trips
from rideloom.workspace import fresh_folder


def main(copies: int = 35, cpus: int = 8, sf_dir: str = "/root/testdata/sf0.1") -> None:
    spark = build_session("scale", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(cpus), "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
    })
    root = fresh_folder(spark, "scale")
    spark.sparkContext.setLogLevel("OFF")
    repeated = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    lines = Tables(spark, sf_dir).raw.repartition(cpus).select(*RAW_FIELDS, repeated.alias("copy")).drop("copy")
    trips.write_shards(lines, f"{root}/lines")
    seconds = []
    for attempt in range(2):
        start = time.perf_counter()
        raw = trips.read_raw(spark, f"{root}/lines")
        check = publish.run_month(raw, MONTH, f"{root}/results-{attempt}", RULES).first()
        seconds.append(round(time.perf_counter() - start, 2))
    print(json.dumps({
        "job": "monthly job", "rows": check["input"], "valid": check["z"], "cpus": cpus,
        "first_run_seconds": seconds[0], "second_run_seconds": seconds[1],
    }))


if __name__ == "__main__":
    main(*map(int, sys.argv[1:]))
