"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "completeness", "source_quality", "sensor_scale_range", "parse_number", "to_meters", "impute_median",
    "bbox_height", "widths_by_band", "band_join_slices", "hull_perimeter", "circumference_select", "ordered_perimeter",
    "fit_proxy", "shoulder_width", "facts_per_key", "kpi_diff", "prev_run", "residual_score", "fit_summary", "gate_eval",
    "assign_distance", "blockers_net", "done_overflow", "registry_append", "manifest_checks", "streaming_dedupe",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tapeline.plans import catalogue
    from tapeline.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("source_quality", "hull_perimeter"):  # warm up: neither the JVM's start nor the workers' counts
        catalogue.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.time()
        catalogue.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
