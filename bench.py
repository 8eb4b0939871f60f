"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
BENCH_CPUS     local threads          (default 8)
BENCH_RUNS     timed runs per query, the median counts (default 3; fits are timed once)
BENCH_QUERIES  blank separated names, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewright.plans.catalog import QUERIES  # noqa: E402
from tidewright.session import build_session  # noqa: E402

HEADLINE = (
    "daily_batch_view daily_batch_view_last_n decode_json encode_json_messages speed_view speed_view_devices "
    "speed_view_players latest_per_key serve_replace_by_key serve_merge_by_key serving_union scan_partitioned "
    "scan_csv_roundtrip filter_complete_stats validate_records validate_reject_reasons profile_table null_profile "
    "html_records html_links_distinct html_fields default_fill name_tokens split_deterministic stratified_split "
    "string_index_freq one_hot log_features standard_scale assemble_features regression_metrics "
    "land_partitioned stream_speed_view stream_relay fit_linear score_batch"
).split()
ONCE = ("fit_", "score_", "stream_score")


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "").split()
    names = list(QUERIES) if wanted == ["all"] else wanted or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    timings, failed = {}, {}
    for name in names:
        try:
            first = seconds(spark, name, sf_dir)  # warm-up; of a fit that is kept for the session, the fit
            repeats = 1 if name.startswith(ONCE) else runs
            timings[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(repeats)), 4)
            if name.startswith("score_"):
                timings[f"{name}_with_fit"] = round(first, 4)
        except Exception as error:  # noqa: BLE001
            failed[name] = f"{type(error).__name__}: {str(error)[:200]}"
        print(f"{name} {timings.get(name, failed.get(name))}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_wall", "value": round(sum(timings.get(n, 0) for n in names), 3), "unit": "sec",
        "queries": timings, "failed": failed, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "spark": spark.version,
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
