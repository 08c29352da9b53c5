"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Every query runs in full into a sink that discards rows; the best of two runs
after one warm-up of the flagship counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gavel.catalog import all_queries  # noqa: E402
from gavel.session import local_session  # noqa: E402
from gavel.sources import derived  # noqa: E402

HEADLINE = [
    "w12_auction_full", "w03_bids_so_far", "w06_bom_streak", "w09_prev_win_bids", "w10_history_sums", "j01_bids_with_auctions",
    "j03_nearest_opponents", "j03_latest_bid_per_opponent", "a01_auction_user_rollup", "a12_win_rate_by_streak",
    "e02_strategy_profit", "e03_threshold_sweep", "e07_best_threshold", "e08_roc_auc", "w13_ev_chunks", "p04_history_pages",
    "p11_feed_bids", "m05_undersample", "l05_next_bid_features", "j07_user_snapshot",
]
RUNS = 2


def timed(run, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "12g"), "bench")
    queries = all_queries()
    timed(queries[HEADLINE[0]], spark, sf_dir)
    times = {}
    for name in HEADLINE:
        times[name] = round(min(timed(queries[name], spark, sf_dir) for _ in range(RUNS)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    bids = derived.bids(spark, sf_dir).count()
    line = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    line["feature_rows_per_sec"] = round(bids / times["w12_auction_full"])
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
