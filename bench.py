"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input directory, ``BENCH_CPUS`` the local threads.
Every query is executed in full into a sink that discards the rows, twice, and the
faster run counts: the first one also loads and compiles code. Loading the lake
that the Gold queries read and storing the relations that several queries share
(once, cold) are entries of their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame

from ridelake.catalogue.queries import QUERIES
from ridelake.catalogue.relations import build_lake, daily_weather, joined_trips, typed_trips
from ridelake.session import build_session

HEADLINE = (
    "silver_trips", "legacy_trips", "notebook_features", "reject_funnel", "fact_trips",
    "avg_duration_monthly", "avg_duration_daily", "station_demand_top10", "station_imbalance",
    "station_imbalance_category", "imbalance_pivot", "rides_by_month", "rides_by_hour",
    "rain_impact", "temp_bucket_impact", "weather_score", "kpi_totals", "kpi_share",
    "kpi_utilization", "kpi_fact_imbalance", "kpi_peak_hour", "kpi_rush_ratio_member",
    "kpi_season_daily", "null_profile", "dataset_summary", "station_concentration",
    "duration_histogram", "numeric_corr", "csv_ingest", "stream_two_drops",
)


def _drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "ridelake-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    _drain(spark.read.parquet(f"{sf_dir}/orders.parquet"))

    seconds: dict[str, float] = {}
    # Relations that queries share are stored once; what that takes is counted, too.
    for name, build in (("build_weather", daily_weather), ("build_trips", typed_trips), ("build_joined", joined_trips)):
        start = time.perf_counter()
        build(spark, sf_dir)
        seconds[name] = round(time.perf_counter() - start, 3)

    def timed(name: str, job) -> None:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            job()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)

    timed("build_lake", lambda: build_lake(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda: _drain(QUERIES[name](spark, sf_dir)))
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
