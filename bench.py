"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import pathlib
import sys
import tempfile
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from terrane.session import get_spark  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = ["l4_buildings_per_landuse", "j1_within_left_join", "j7_nearest_road", "a7_zone_area", "j2_within_buffer_zone",
            "r12_zonal_summary", "l8_lidar_heights", "p5_grid_inverse_distance", "p3_ground_classification",
            "c1_density_clusters", "i4_median_composite", "i10_monthly_ndvi", "l10_land_suitability"]


def main(scratch: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
                                                    "spark.driver.memory": "16g", "spark.checkpoint.dir": scratch})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["l3_raw_landuse"](spark, sf_dir).write.format("noop").mode("overwrite").save()   # start-up is not the first query's
    seconds = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="terrane-bench-") as folder:
        main(folder)
