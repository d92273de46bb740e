"""Time the headline queries; prints one JSON line.

Each query is built and run to the end (all rows, nothing collected) after one warm-up run of the flagship on
the same session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from checks.session import local_session  # noqa: E402

FLAGSHIP = "predict_labeled"
HEADLINE = ["predict_labeled", "train_labeled", "predict_unlabeled", "train_unlabeled", "pop_grid", "footprint_grid", "mask_cells",
            "footprint_fraction", "zonal_building_area", "fit_per_country", "resample_sum", "pyramid_sum", "knn_density_join",
            "coverage_change", "assemble_tiles"]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    run(spark, FLAGSHIP, sf_dir)
    seconds = {name: run(spark, name, sf_dir) for name in HEADLINE}
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
