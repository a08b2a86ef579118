"""Time the reports by team; prints one JSON line.

Every report runs in the library's form and as the plain join-then-aggregate SQL,
in turns in one session, so that both see the same machine. `value` and `queries`
are the library's medians, `direct` those of the plain SQL.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS
(timed runs per report and form), BENCH_ONLY (some reports, comma-joined),
BENCH_MEMORY (driver memory).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from fieldtally.catalog.frames import TABLES, survey_cte  # noqa: E402
from fieldtally.catalog.report_sql import REPORT_SQL  # noqa: E402
from fieldtally.catalog.reports import REPORTS, report_table  # noqa: E402


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fieldtally-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_ONLY")
    spark = session(cpus)

    def library(key: str) -> DataFrame:
        return report_table(spark, sf_dir, key).stats

    def plain(key: str) -> DataFrame:
        sql = REPORT_SQL[key]
        return spark.sql(survey_cte(*sql.frames) + sql.text("team"))

    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        spark.read.parquet(path).createOrReplaceTempView(table)

    keys = [k for k in REPORTS if only is None or k in only.split(",")]
    timings, direct = {}, {}
    for key in keys:
        run(library(key)), run(plain(key))
        pairs = [(run(library(key)), run(plain(key))) for _ in range(runs)]
        timings[key] = statistics.median(a for a, _ in pairs)
        direct[key] = statistics.median(b for _, b in pairs)
    scale = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "survey reports, total of median seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timings.items()},
                "sf": float(scale.group(1)) if scale else sf_dir,
                "direct_value": round(sum(direct.values()), 3),
                "direct": {k: round(v, 3) for k, v in direct.items()},
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
