"""Headline queries, timed: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and the local cores. Every
query is planned and run whole, its result taken row by row by a sink that keeps nothing; the time is the median
of three runs after one that warms up. For the two yardsticks the line also has requests per second and how often
the lookup is scanned.
"""

import contextlib
import io
import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from lookfuse.catalog import QUERIES

HEADLINES = [
    "enrich_lineitem_part",
    "asof_latest",
    "asof_within",
    "enrich_merge_new",
    "enrich_composite_key",
    "enrich_key_alias",
    "restrict_template",
    "restrict_fn",
    "restrict_dispatch",
    "scope_any_request",
    "theta_nearest",
    "representative_per_key",
    "duplicates_first",
    "match_count",
    "select_latest",
    "select_reduce",
    "select_python",
    "select_with_request",
    "lookup_pairs",
]


# Yardstick, its requests, a column only its lookup has.
YARDSTICKS = {
    "enrich_lineitem_part": ("lineitem", "p_name"),
    "asof_latest": ("events", "o_totalprice"),
}


def scans(df: DataFrame, column: str) -> int:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return sum(column in schema for schema in re.findall(r"ReadSchema: (.*)", text.getvalue()))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lookfuse-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        seconds(name)
        timings[name] = round(statistics.median(seconds(name) for _ in range(3)), 3)
    measured = {
        name: {
            "requests_per_sec": round(spark.read.parquet(f"{folder}/{table}.parquet").count() / timings[name]),
            "lookup_scans": scans(QUERIES[name](spark, folder), column),
        }
        for name, (table, column) in YARDSTICKS.items()
        if name in timings
    }
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "yardsticks": measured,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
