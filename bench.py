"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and threads.
Every query runs in full; its rows are consumed by a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "update_join_last",
    "point_in_polygon",
    "nearest_site_by_year",
    "neighbor_mean",
    "neighbor_exposure",
    "station_day_mean",
    "moving_mean_centred",
    "value_profile",
    "accuracy_overall",
    "time_levels",
    "cell_errors",
    "errors_across_cells",
    "hexagon_bins",
    "county_inventory",
    "tile_mosaic",
    "weather_days",
    "areal_interpolation",
    "compact_counts",
    "training_table",
    "prediction_cells",
    "prediction_table",
    "station_observations",
    "merged_regions",
]


def main() -> None:
    from airgrid.session import build_session
    from checks import grid_and_rollups, joins_and_cleaning, models_and_tables  # noqa: F401
    from checks.registry import QUERIES

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus), spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    # One small job first, so that the first query does not pay for starting the engine.
    spark.read.parquet(f"{sf}/nation.parquet").groupBy("n_regionkey").count().collect()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    line = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
