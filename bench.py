"""Time the queries on one machine and print one JSON line.

BENCH_SF_DIR  folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    runs of every action, of which the fastest counts (default 2)
BENCH_ROWS    rows of the stored table, made of copies of all sales (default 5000000)

Queries read the tables as they are. The jobs and scans named ``stored_*`` work on
one stored table of about ``BENCH_ROWS`` rows, whose size is printed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakestrata.functions import as_doubles  # noqa: E402
from lakestrata.operators import (  # noqa: E402
    category_revenue,
    count_rows,
    daily_revenue,
    rank_in_day,
    region_type_stats,
    rolling_revenue,
    user_region_revenue,
)
from lakestrata.plans import QUERIES, views  # noqa: E402
from lakestrata.sources import (  # noqa: E402
    VersionedTable,
    read_table,
    run_folder,
    write_table,
)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
ROWS = int(os.environ.get("BENCH_ROWS", "5000000"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lakestrata-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], None]) -> float:
    """Fastest of the runs, the same number for every action."""
    best = float("inf")
    for _ in range(RUNS):
        started = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - started)
    return round(best, 3)


def stored_table_times(spark: SparkSession) -> tuple[dict[str, float], int]:
    """Times over one stored table, and its rows: write, full count and filtered
    count per format and as a versioned table, and each job from the stored table
    to a stored result."""
    root = run_folder(spark, "bench")
    write_table(views.sales(spark, SF_DIR), f"{root}/sales")
    sales = read_table(spark, f"{root}/sales")
    copies = max(1, round(ROWS / sales.count()))
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    write_table(sales.withColumn("copy", copy).drop("copy"), f"{root}/silver")
    silver = read_table(spark, f"{root}/silver")
    products = views.products(spark, SF_DIR)
    times = {}

    def scans(name: str, read: Callable[[], DataFrame]) -> None:
        times[f"stored_full_count_{name}"] = seconds(lambda: consume(count_rows(read())))
        times[f"stored_region_count_{name}"] = seconds(
            lambda: consume(count_rows(read(), "ASIA"))
        )

    for fmt in ("parquet", "orc"):
        path = f"{root}/{fmt}"
        times[f"stored_write_{fmt}"] = seconds(lambda: write_table(silver, path, fmt))
        scans(fmt, lambda: read_table(spark, path, fmt))
    versioned = VersionedTable(spark, f"{root}/versioned")
    versioned.overwrite(silver, partition_by=["region"])
    scans("versioned", versioned.current)
    jobs = {
        "aggregation": lambda: region_type_stats(silver),
        "broadcast_join": lambda: category_revenue(silver, products, "broadcast"),
        "shuffle_join": lambda: category_revenue(silver, products, "shuffle"),
        "windows": lambda: as_doubles(rank_in_day(rolling_revenue(daily_revenue(silver)))),
        "user_revenue_sorted": lambda: user_region_revenue(silver),
    }
    for name, build in jobs.items():
        times[f"stored_job_{name}"] = seconds(lambda: write_table(build(), f"{root}/{name}"))
    return times, silver.count()


def main() -> None:
    spark = session()
    consume(QUERIES["revenue_by_region_type"](spark, SF_DIR))  # starts the JVM's compilers
    times = {
        name: seconds(lambda: consume(build(spark, SF_DIR))) for name, build in QUERIES.items()
    }
    stored, stored_rows = stored_table_times(spark)
    times.update(stored)
    line = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "stored_rows": stored_rows,
        "lineitem_rows": views.table(spark, SF_DIR, "lineitem").count(),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
