"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR picks the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores, and
BENCH_QUERIES a comma-separated list of registered queries. Results are computed in full and
thrown away by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from wellspring.plans.registry import QUERIES
from wellspring.session import configure

HEADLINE = [
    "x04_script_io",
    "x08_conf_jobs",
    "x16_ddl",
    "a01_table_deps",
    "a02_table_attrs",
    "g01_warehouse_chains",
    "g05b_wide_lake_report",
    "g05c_lake_chains",
    "n08_process_groups",
    "n10_flow_matches",
    "j04_chain_servers",
    "g04_server_report",
    "l01_projections",
    "l02_nested_projections",
    "l10_chain_lineage",
    "l12_lake_table_tracking",
    "l16_source_fields",
    "l13_warehouse_tracking",
    "g07_cooccurrence",
    "r02_dependencies",
    "r05_diagnostic",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # start-up cost is not a query's
    spark.read.parquet(f"{sf_dir}/part.parquet").groupBy("p_brand").count().count()

    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
