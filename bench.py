"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs into the noop sink, so every row is computed and none is
collected.  ``queries`` has one cold run each.  ``pairs`` compares two ways to
the same rows, such as plain and cut windows: after a warm-up the median of three
runs of either, taken in turn, and their ratio.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from broadloom.queries import registered  # noqa: E402
from broadloom.session import build_session  # noqa: E402

HEADLINE = [
    "pl_settlement", "pl_settlement_chunked", "win_percent_rank_global", "percent_rank_distributed", "percent_rank_skewed",
    "max_percentile_by_key", "win_moving_avg", "win_moving_avg_blocks", "win_ntile_bounds", "win_lead_lag", "topk_two_phase",
    "agg_group_basic", "agg_cube", "agg_argmax", "agg_salted", "agg_join_measure", "agg_join_measure_salted", "join_salted",
    "join_salted_hot_only", "join_sort_merge", "join_broadcast_hint", "join_then_agg", "agg_then_join", "join_copartitioned",
    "agg_reduce_by_key", "bucketed_agg", "dpp_join", "pair_cooccurrence", "pair_cooccurrence_parts", "word_count_top",
    "parse_access_log", "log_daily_avg_per_host", "log_top_endpoints", "table_merge", "sessions_batch", "stream_tumbling",
    "stream_stock_state",
]

#: (name, the plain way, the other way)
PAIRS = [
    ("running_sum_hot", "win_running_sum_hot_plain", "win_running_sum_hot"),
    ("moving_avg_hot", "win_moving_avg_hot_plain", "win_moving_avg_hot"),
    ("percent_rank", "win_percent_rank_global", "percent_rank_distributed"),
    ("settlement", "pl_settlement", "pl_settlement_chunked"),
    ("aggregate_before_join", "join_then_agg", "agg_then_join"),
]


def run(spark, folder, name):
    start = time.perf_counter()
    registered()[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def pairs(spark, folder):
    out = {}
    for label, *names in PAIRS:
        for name in names:
            run(spark, folder, name)
        taken = {name: [] for name in names}
        for _ in range(3):
            for name in names:
                taken[name].append(run(spark, folder, name))
        plain, other = (statistics.median(taken[name]) for name in names)
        out[label] = {"plain": round(plain, 3), "other": round(other, 3), "ratio": round(other / plain, 2)}
    return out


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()
    wanted = [name for name in sys.argv[1:] if name != "pairs"] or ([] if sys.argv[1:] else HEADLINE)
    times = {name: round(run(spark, folder, name), 3) for name in wanted}
    compared = {} if [name for name in sys.argv[1:] if name != "pairs"] else pairs(spark, folder)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder).removeprefix("sf"), "pairs": compared}))


if __name__ == "__main__":
    main()
