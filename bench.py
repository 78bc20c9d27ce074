"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import load  # noqa: E402
from tidewell.session import local_session  # noqa: E402

HEADLINE = [
    "agg1_resample_mean", "win1_interpolate", "win3_fill_sweep", "win5_run_length", "win8_rolling_median_center", "win9_lowpass",
    "tim2_regularize", "tim4_interp_to", "tim8_disaggregate", "mrg1_ts_merge", "mrg2_ts_merge_strict", "mrg3_splice_first", "mrg6_read_series",
    "scr5_median_twoside", "scr9_screen", "rec6_plan_update", "rec10_merge_flags", "join13_value_asof", "src2_read_provider", "prd1_regression_impute",
    "entry_screened_daily",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, _ = load()
    chosen = sys.argv[1:] or HEADLINE
    qs["flt5_mask_range"](spark, sf).write.format("noop").mode("overwrite").save()  # start the engine
    times = {}
    for name in chosen:
        t = time.time()
        qs[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
